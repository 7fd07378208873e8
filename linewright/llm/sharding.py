"""A uniform shuffle into shards of exact sizes by a communication matrix (op7)."""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from linewright.session import materialize

from .common import query, table, whole

#: Rows of a shard that are permuted and numbered together.
ROWS_TOGETHER = 20_000
#: Nodes of the splitting tree beyond which its levels are dealt over the cluster.
NODES_TOGETHER = 64


def uniform(*key: Column | str) -> Column:
    """A number in [0, 1) that the key decides."""
    return F.shiftrightunsigned(F.xxhash64(*key), 11).cast("double") * F.lit(2.0**-53)


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """use(value), where the value is worked out once."""
    return F.transform(F.array(value), use)[0]


def hypergeometric(draws: Column, good: Column, total: Column, u: Column) -> Column:
    """How many of `draws` out of `total`, `good` of them marked, are marked: the value that u in [0, 1) stands for.

    Walks from the most likely count outward by the ratio of neighbouring probabilities, as far as nine
    standard deviations and twenty counts (beyond, less than 1e-15 is left), so neither factorials nor draws one by one.
    """
    n, g, t = (c.cast("double") for c in (draws, good, total))
    low, high = F.greatest(F.lit(0).cast("long"), draws + good - total), F.least(draws, good)
    mode = F.least(high, F.greatest(low, F.floor((n + 1) * (g + 1) / (t + 2)).cast("long")))
    deviation = F.sqrt(F.greatest(F.lit(0.0), n * g / t * (1 - g / t) * (t - n) / F.greatest(t - 1, F.lit(1.0))))
    span = (F.ceil(9 * deviation) + 20).cast("long")
    none = F.array().cast("array<bigint>")

    def counts(x: Column, up: bool) -> Column:
        end = F.least(x["high"], x["mode"] + x["span"]) if up else F.greatest(x["low"], x["mode"] - x["span"])
        some = F.sequence(x["mode"] + 1, end) if up else F.sequence(x["mode"] - 1, end, F.lit(-1).cast("long"))
        return F.when(end > x["mode"] if up else end < x["mode"], some).otherwise(none)

    def ratio(x: Column, k: Column, up: bool) -> Column:
        n, g, t = x["n"], x["g"], x["t"]
        return (g - k + 1) * (n - k + 1) / (k * (t - g - n + k)) if up else (k + 1) * (t - g - n + k + 1) / ((g - k) * (n - k))

    def weight(x: Column, up: bool) -> Column:
        start = F.struct(F.lit(1.0).alias("w"), F.lit(0.0).alias("s"))

        def step(a: Column, k: Column) -> Column:
            return let(a["w"] * ratio(x, k, up), lambda w: F.struct(w.alias("w"), (a["s"] + w).alias("s")))

        return F.aggregate(counts(x, up), start, step, lambda a: a["s"])

    def reach(x: Column, up: bool, target: Column) -> Column:
        """The first count at which the weights' sum is at least the target, or the last."""
        start = F.struct(F.lit(1.0).alias("w"), F.lit(0.0).alias("s"), x["mode"].alias("k"))

        def step(a: Column, k: Column) -> Column:
            return let(a["w"] * ratio(x, k, up), lambda w: F.struct(w.alias("w"), (a["s"] + w).alias("s"), k.alias("k")))

        return let(target, lambda target: F.aggregate(counts(x, up), start, lambda a, k: F.when(a["s"] >= target, a).otherwise(step(a, k)), lambda a: a["k"]))

    def pick(x: Column) -> Column:
        sums = F.struct(weight(x, True).alias("right"), weight(x, False).alias("left"))

        def by(w: Column) -> Column:
            target = u * (1 + w["right"] + w["left"])
            return (
                F.when(target < 1, x["mode"])
                .when(target < 1 + w["right"], reach(x, True, target - 1))
                .otherwise(reach(x, False, target - 1 - w["right"]))
            )

        return let(sums, by)

    known = F.struct(n.alias("n"), g.alias("g"), t.alias("t"), low.alias("low"), high.alias("high"), mode.alias("mode"), span.alias("span"))
    return F.when(total <= 0, F.lit(0).cast("long")).when(low == high, low).otherwise(let(known, pick))


def communication_matrix(sizes: DataFrame, shards: int, seed: int) -> DataFrame:
    """(src, counts): how many rows of each source partition go to each shard, drawn as a uniform permutation would.

    `sizes` has (src, n), a row for each partition. Shard sizes differ by one at most. A node of a binary tree is a run of
    partitions and what each shard takes from it; splitting it draws, shard by shard, what the shard takes from the
    run's first half. Nodes of a level are independent rows.
    """
    runs = sizes.groupBy().agg(F.sort_array(F.collect_list(F.struct("src", "n"))).alias("run")).filter(F.size("run") > 0)
    total = F.aggregate("run", F.lit(0).cast("long"), lambda a, x: a + x["n"])
    share = lambda j: F.expr(f"total div {shards}") + F.when(j < F.expr(f"total % {shards}"), 1).otherwise(0)
    nodes = runs.withColumn("total", total)
    nodes = nodes.select("run", F.transform(F.sequence(F.lit(0), F.lit(shards - 1)), share).alias("takes"))
    depth = max(0, math.ceil(math.log2(max(1, sizes.count()))))
    for level in range(depth):
        if 1 << level == NODES_TOGETHER:
            nodes = nodes.repartition(F.col("run")[0]["src"])
        half = F.expr("size(run) div 2")
        left = F.slice("run", 1, half)
        draws = F.aggregate(left, F.lit(0).cast("long"), lambda a, x: a + x["n"])
        everything = F.aggregate("takes", F.lit(0).cast("long"), lambda a, x: a + x)
        start = F.struct(F.array().cast("array<bigint>").alias("got"), F.col("draws").alias("open"), F.col("everything").alias("all"))

        def draw(a: Column, take: Column) -> Column:
            u = uniform(F.lit(seed), F.lit(level), F.col("run")[0]["src"], F.size(a["got"]))

            def taken(x: Column) -> Column:
                return F.struct(F.concat(a["got"], F.array(x)).alias("got"), (a["open"] - x).alias("open"), (a["all"] - take).alias("all"))

            return let(hypergeometric(a["open"], take, a["all"], u), taken)

        split = nodes.withColumns({"draws": draws, "everything": everything})
        split = split.withColumn("got", F.when(half > 0, F.aggregate("takes", start, draw, lambda a: a["got"])).otherwise(F.col("takes")))
        first = F.struct(F.when(half > 0, left).otherwise(F.col("run")).alias("run"), F.col("got").alias("takes"))
        rest = F.zip_with("takes", "got", lambda a, b: a - b)
        second = F.struct(F.expr("slice(run, size(run) div 2 + 1, size(run))").alias("run"), rest.alias("takes"))
        nodes = split.select(F.explode(F.when(half > 0, F.array(first, second)).otherwise(F.array(first))).alias("node")).select("node.*")
    return nodes.select(F.col("run")[0]["src"].alias("src"), F.col("takes").alias("counts"))


def shuffle_into_shards(rows: DataFrame, shards: int = 40, seed: int = 1) -> DataFrame:
    """All rows and columns, and shard (int), slot (long, gapless from 0 in its shard): a uniformly random order.

    Shard sizes differ by one at most. Partitions of the input draw exact counts for each shard, permute their own rows and
    cut the order by these counts; shards permute what they got. Random numbers are hashes of the seed and a row number,
    and the numbered rows are written first, so a task that runs again gives the same rows. A shard is numbered in random
    pieces of about ROWS_TOGETHER rows, so no task holds a shard. Values of rows play no part: nulls, repeated
    rows, long texts and hot keys are rows like others. An empty table gives no rows. Columns named shard or slot are an error.
    """
    if {"shard", "slot"} & {c.lower() for c in rows.columns}:
        raise ValueError("there is a column shard or slot already")
    packed = rows.select(F.struct(*[F.col(f"`{c}`") for c in rows.columns]).alias("row"))
    held = packed.select("row", F.spark_partition_id().alias("src"), F.monotonically_increasing_id().alias("uid"))
    held = materialize(held, "numbered")
    sizes = held.groupBy("src").agg(F.count("*").alias("n"))
    matrix = materialize(communication_matrix(sizes, shards, seed), "matrix")
    ends = F.transform(
        F.sequence(F.lit(1), F.lit(shards)), lambda j: F.aggregate(F.slice("counts", 1, j), F.lit(0).cast("long"), lambda a, x: a + x)
    )
    matrix = matrix.select("src", ends.alias("ends"))
    own = Window.partitionBy("src").orderBy(F.xxhash64(F.lit(seed), F.lit("own"), "uid"), "uid")
    dealt = held.withColumn("at", F.row_number().over(own) - 1).join(matrix, "src")
    dealt = dealt.withColumn("shard", F.size(F.filter("ends", lambda e: e <= F.col("at"))))
    pieces = max(1, math.ceil(held.count() / shards / ROWS_TOGETHER))
    u = uniform(F.lit(seed), F.lit("slot"), "uid")
    dealt = materialize(dealt.select("row", "uid", "shard", F.floor(u * pieces).cast("int").alias("piece")), "dealt")
    before = Window.partitionBy("shard").orderBy("piece").rowsBetween(Window.unboundedPreceding, -1)
    counts = dealt.groupBy("shard", "piece").agg(F.count("*").alias("n"))
    offsets = counts.select("shard", "piece", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset"))
    within = Window.partitionBy("shard", "piece").orderBy(u, "uid")
    numbered = dealt.withColumn("at", F.row_number().over(within) - 1).join(offsets, ["shard", "piece"])
    return numbered.select("row.*", "shard", (F.col("offset") + F.col("at")).alias("slot"))


@query("op7_hypergeometric_shards")
def hypergeometric_shards(spark: SparkSession, folder: str) -> DataFrame:
    """All documents in 40 shards."""
    text = whole("text").cast("binary")
    docs = table(spark, folder, "documents").select(
        "doc_id", (F.length(text) + 16).cast("long").alias("size"), F.crc32(text).alias("text_crc32"), F.lit("rows").alias("law")
    )
    return shuffle_into_shards(docs).withColumn("grown_shard", F.lit(None).cast("int"))
