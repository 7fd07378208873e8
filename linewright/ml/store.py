"""Fitted models by version, the pointer to the champion, and the log of alias changes."""

from __future__ import annotations

import json

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.lifecycle import EVENTS, alias_state, may_become
from ..sources.pointer import point, pointed


class ModelStore:
    """A folder with a model and its facts per version, the name of the current champion, and an append-only log.

    A model is whole before the pointer moves, so a reader gets the old champion or the new one.
    """

    def __init__(self, spark: SparkSession, path: str) -> None:
        self.spark, self.path = spark, path.rstrip("/")

    def _folder(self, version: int) -> str:
        return f"{self.path}/version={version}"

    def save(self, version: int, model: PipelineModel, facts: dict) -> None:
        """Store a model over raw columns with what is known of it: threshold, run, measures."""
        model.write().overwrite().save(f"{self._folder(version)}/model")
        point(self.spark, f"{self._folder(version)}/facts.json", json.dumps(facts, sort_keys=True))

    def load(self, version: int) -> tuple[PipelineModel, dict]:
        found = pointed(self.spark, f"{self._folder(version)}/facts.json")
        if found is None:
            raise ValueError(f"no model of version {version} is stored")
        return PipelineModel.load(f"{self._folder(version)}/model"), json.loads(found)

    def crown(self, version: int) -> None:
        """Make a stored version the champion."""
        self.load(version)
        point(self.spark, f"{self.path}/champion", str(version))

    def champion(self) -> tuple[int, PipelineModel, dict] | None:
        """Version, model and facts of the champion, or None before the first promotion."""
        version = pointed(self.spark, f"{self.path}/champion")
        return None if version is None else (int(version), *self.load(int(version)))

    def events(self) -> DataFrame:
        """The log of alias changes, as they were appended: ``version, alias, tags, at, seq``."""
        from pyspark.errors import AnalysisException

        try:
            return self.spark.read.schema(f"{EVENTS}, seq long").parquet(f"{self.path}/events")
        except AnalysisException:
            return self.spark.createDataFrame([], f"{EVENTS}, seq long")

    def aliases(self) -> DataFrame:
        """The alias each version has now."""
        return alias_state(self.events(), "version", ["at", "seq"])

    def append(self, changes: list[tuple[int, str, dict[str, str]]]) -> None:
        """Append alias changes in order, all or none: one that the life cycle does not know raises and leaves the log as it is.

        One writer at a time; the changes of a promotion are one file."""
        versions = sorted({version for version, _, _ in changes})
        now = {r["version"]: r["alias"] for r in self.aliases().filter(F.col("version").isin(versions)).collect()}
        last = self.events().agg(F.max("seq")).first()[0]
        rows = []
        for version, alias, tags in changes:
            if not may_become(now.get(version), alias):
                raise ValueError(f"version {version} is {now.get(version) or 'new'} and can't become {alias}")
            now[version] = alias
            rows.append((version, alias, {k: str(v) for k, v in tags.items()}, (-1 if last is None else last) + 1 + len(rows)))
        frame = self.spark.createDataFrame(rows, "version int, alias string, tags map<string,string>, seq long").coalesce(1)
        frame.withColumn("at", F.current_timestamp()).select("version", "alias", "tags", "at", "seq").write.mode("append").parquet(f"{self.path}/events")
