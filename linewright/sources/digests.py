"""Order-free content digests of tables, and the change feed that reads only partitions whose digests differ."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .writers import changed_rows, overwrite

#: Digests add up modulo 2 ** 64.
WORD = 1 << 64


def row_text(columns: list[str]) -> Column:
    """A row's values as one text: `-` for NULL, else the number of characters, `:` and the value, so that different rows have
    different texts."""
    values = [F.col(f"`{c}`").cast("string") for c in columns]
    return F.concat(*[F.coalesce(F.concat(F.length(v).cast("string"), F.lit(":"), v), F.lit("-")) for v in values])


def _words(text: Column) -> list[Column]:
    """Both halves of a text's md5 as whole numbers."""
    digest = F.md5(text.cast("binary"))
    return [F.conv(F.substring(digest, at, 16), 16, 10).cast("decimal(38,0)") for at in (1, 17)]


def _modulo(total: Column) -> Column:
    return F.pmod(total, F.lit(str(WORD)).cast("decimal(38,0)")).cast("decimal(20,0)")


def _shown(high: Column, low: Column) -> Column:
    return F.concat_ws(":", high.cast("string"), low.cast("string"))


def fingerprint(df: DataFrame, by: list[str] | None = None, columns: list[str] | None = None) -> DataFrame:
    """Row count and an order-free content digest of ``columns`` (all, if none are given), overall or per value of ``by``: the sums of both halves of each row's md5,
    modulo 2 ** 64. Sums of parts add up to the sum of the whole, so tasks send one row per group; any SQL engine with md5
    can state it."""
    high, low = _words(row_text(columns or df.columns))
    sums = [F.count(F.lit(1)).alias("row_count"), F.sum(high).alias("_h"), F.sum(low).alias("_l")]
    grouped = (df.groupBy(*by) if by else df.groupBy()).agg(*sums)
    zero = F.lit(0).cast("decimal(38,0)")
    digest = _shown(_modulo(F.coalesce("_h", zero)), _modulo(F.coalesce("_l", zero)))
    return grouped.select(*(by or []), "row_count", digest.alias("digest"), F.lit(df.schema.json()).alias("schema_json"))


def digest_tree(df: DataFrame, by: list[str]) -> DataFrame:
    """The fingerprints of all partitions and of what they make up: one row per value of ``by`` (depth ``len(by)``), per value of all
    but the last of ``by``, and so on to one for the whole table (depth 0). Columns beyond a row's depth are NULL.

    The rows are read once; upper levels add up the level below.
    """
    level = fingerprint(df, by).drop("schema_json")
    parts = F.split("digest", ":")
    level = level.select(*by, "row_count", *[parts[i].cast("decimal(38,0)").alias(n) for i, n in enumerate(("_h", "_l"))])
    # all levels from the partitions' rows, in one pass over these
    rows = level.rollup(*by).agg(F.sum("row_count").alias("row_count"), F.sum("_h").alias("_h"), F.sum("_l").alias("_l"), F.grouping_id().alias("_g"))
    depth = F.lit(len(by)) - F.bit_count(F.col("_g"))
    return rows.select(*by, depth.alias("depth"), "row_count", _shown(_modulo(F.col("_h")), _modulo(F.col("_l"))).alias("digest"))


def changed_partitions(old: DataFrame, new: DataFrame, by: list[str]) -> list[dict]:
    """The values of ``by`` whose digests differ between two trees of :func:`digest_tree`, or that one of them lacks.

    From the whole down: below what is equal nothing is compared. The driver gets the changed partitions of each depth.
    """
    differing: list[dict] = [{}]
    for depth in range(len(by) + 1):
        names = by[:depth]
        within = _any_of(differing, by[: depth - 1] if depth else [])
        a = old.filter((F.col("depth") == depth) & within).select(*names, F.struct("row_count", "digest").alias("_a"))
        b = new.filter((F.col("depth") == depth) & within).select(*[F.col(n).alias(f"_{n}") for n in names], F.struct("row_count", "digest").alias("_b"))
        same = reduce(lambda x, y: x & y, [F.col(n).eqNullSafe(F.col(f"_{n}")) for n in names], F.lit(True))
        if depth == 0:
            tops = [list(map(tuple, side.collect())) for side in (a, b)]
            if tops[0] == tops[1]:
                return []
            continue
        joined = a.join(b, same, "full").filter(~F.col("_a").eqNullSafe(F.col("_b")))
        there = F.col("_a").isNotNull()
        values = [F.when(there, F.col(n)).otherwise(F.col(f"_{n}")).alias(n) for n in names]
        differing = [r.asDict() for r in joined.select(*values).collect()]
    return differing


def _any_of(values: list[dict], names: list[str]) -> Column:
    """Whether a row lies in one of the partitions; prunes files where the columns are directories."""
    if not names:
        return F.lit(True)
    each = [reduce(lambda x, y: x & y, [F.col(n).isNull() if v[n] is None else F.col(n) == v[n] for n in names]) for v in values]
    return reduce(lambda x, y: x | y, each, F.lit(False))


def overwrite_snapshot(df: DataFrame, path: str, by: list[str]) -> None:
    """Replace a table that is partitioned by ``by`` and, beside it, the tree of its digests."""
    overwrite(df, path, by)
    written = df.sparkSession.read.schema(df.schema).parquet(path)
    columns = [*[c for c in df.columns if c not in by], *by]
    overwrite(digest_tree(written.select(*columns), by).coalesce(1), f"{path}.digests")


def snapshot_changes(spark: SparkSession, old: str, new: str, keys: list[str], by: list[str]) -> DataFrame:
    """:func:`changed_rows` between two snapshots of :func:`overwrite_snapshot`: only partitions whose digests differ are
    read and joined. A row that moved to another partition changes both, so it is found as an update."""
    trees = [spark.read.parquet(f"{path}.digests") for path in (old, new)]
    within = _any_of(changed_partitions(*trees, by), by)
    before, after = (spark.read.parquet(path).filter(within) for path in (old, new))
    return changed_rows(before, after.select(*before.columns), keys)
