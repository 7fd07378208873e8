"""The streaming forms of the operators. Each is the batch operator on a watermarked stream."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import parse_timestamp
from ..operators.rules import flag_quarantine, rules_for
from ..operators.windows import tumbling
from ..sources.writers import stream_to_table

# How late rows may be.
LABEL_DELAY = "30 days"
WINDOW_DELAY = "2 hours"


def watermarked(df: DataFrame, time: str, delay: str) -> DataFrame:
    """Watermarks need TIMESTAMP, not the zone-free type."""
    return df.withColumn(time, F.col(time).cast("timestamp")).withWatermark(time, delay)


def quarantine_stream(events: DataFrame, tag: str, time: str) -> DataFrame:
    """Parse the time and flag rows that break a rule. Written partitioned by
    ``is_quarantined``, one pass over the input yields both tables as directories."""
    parsed = events.withColumn(time, parse_timestamp(F.col(time).cast("string")))
    flagged = flag_quarantine(parsed, rules_for(tag))
    return flagged.withColumn("quarantine_timestamp", F.when(F.col("is_quarantined"), F.current_timestamp()))


def labelled_stream(inspections: DataFrame, labels: DataFrame, delay: str = LABEL_DELAY) -> DataFrame:
    """Left outer join of two streams: labels that arrive 0 to 30 days after the inspection.

    A matched row leaves at once. An unmatched inspection leaves with NULL label when the
    watermark, the smaller one of both streams, has passed its 30 days; so a run has to see
    later rows on both sides. State is held for both sides over watermark plus range.
    """
    left = watermarked(inspections, "timestamp", delay)
    right = watermarked(labels, "label_available_date", delay).withColumnRenamed("unit_id", "label_unit_id")
    in_range = F.expr(
        "unit_id = label_unit_id AND label_available_date >= timestamp"
        " AND label_available_date <= timestamp + INTERVAL 30 DAYS"
    )
    joined = left.join(right, in_range, "left").drop("label_unit_id")
    return joined.withColumn("join_timestamp", F.current_timestamp())


def windowed_stream(
    events: DataFrame,
    keys: list[str],
    time: str,
    size: str,
    measures: list[str],
    label: str | None = None,
    label_known: str | None = None,
    delay: str = WINDOW_DELAY,
    digits: int | None = None,
    slide: str | None = None,
) -> DataFrame:
    """Window table of a stream, tumbling or with ``slide`` overlapping. A window appears once the
    watermark has passed its end; rows later than that are left out."""
    rows = watermarked(events, time, delay)
    return tumbling(rows, keys, time, size, measures, label, label_known, digits, slide)


def run_to_end(df: DataFrame, path: str, checkpoint: str, partition_by: list[str] | None = None) -> None:
    """Take everything present, append it to the table, and stop."""
    stream_to_table(df, path, checkpoint, partition_by).awaitTermination()
