"""What came before a time slice, without a group that holds all slices of a key."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Slices of one level that make a slice of the next.
FAN = 64
#: Microseconds from 1970 that hold all timestamps, in either direction.
HORIZON = 1 << 58

#: From a column of partial states to their merged state; usable as an aggregate and over a window.
Merge = dict[str, Callable[[], Column]]


def levels(width: int) -> list[int]:
    """Widths in microseconds, each ``FAN`` times the one before, up to one that spans all time."""
    out = [width]
    while out[-1] * FAN <= HORIZON:
        out.append(out[-1] * FAN)
    return out


def _start(column: str, width: int) -> Column:
    return F.col(column) - F.pmod(F.col(column), F.lit(width).cast("long"))


def climb(df: DataFrame, keys: list[str], width: int) -> DataFrame:
    """Each row once per level: with its keys as ``_key``, the slice of the level that holds it (``_node``) and the wider slice
    that holds that (``_parent``)."""
    widths = levels(width)
    steps = [
        F.struct(
            F.lit(k).alias("_level"),
            _start("_slice", w).alias("_node"),
            (_start("_slice", widths[k + 1]) if k + 1 < len(widths) else F.lit(0).cast("long")).alias("_parent"),
        )
        for k, w in enumerate(widths)
    ]
    return df.select(F.struct(*keys).alias("_key"), "*", F.inline(F.array(*steps)))


def before_slices(states: DataFrame, asked: DataFrame, keys: list[str], width: int, merge: Merge) -> DataFrame:
    """For each asked ``(keys, _slice)`` the merged states of all earlier slices of its keys; asked slices that nothing
    precedes are left out.

    ``states`` holds one row per ``(keys, _slice)`` with the columns of ``merge``; slices are ``width`` microseconds wide and
    start at multiples of it. Slices add up to wider ones, minutes to hours to days so to say, ``FAN`` at a time. What precedes
    a slice is, on each level, its earlier siblings below the same wider slice: one short window per wider slice and
    level, all levels in one pass, then one merge of the few levels. No group holds more than ``2 * FAN`` rows, however long a
    key's history is. NULL keys are equal to each other.
    """
    at = ["_key", "_level", "_parent", "_node"]
    nodes = climb(states, keys, width).groupBy(*at).agg(*[f().alias(name) for name, f in merge.items()])
    wanted = climb(asked.select(*keys, "_slice"), keys, width)
    questions = wanted.select(*at).distinct().withColumn("_asked", F.lit(True))
    siblings = Window.partitionBy("_key", "_level", "_parent").orderBy("_node").rangeBetween(Window.unboundedPreceding, -1)
    answers = (
        nodes.unionByName(questions, allowMissingColumns=True)
        .withColumns({name: f().over(siblings) for name, f in merge.items()})
        .filter("_asked")
        .select(*at, *merge)
    )
    none = [F.col(name).isNull() for name in merge]
    for more in none[1:]:
        none[0] = none[0] & more
    found = wanted.join(answers.filter(~none[0]), at)
    return found.groupBy("_key", "_slice").agg(*[f().alias(name) for name, f in merge.items()]).select("_key.*", "_slice", *merge)
