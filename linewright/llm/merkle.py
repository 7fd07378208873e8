"""Merkle manifest of a data set as a postorder append log, with proofs for every row (op13).

Rows of a group (a source), in the order of their ids, are the leaves of a tree: each run of ARITY nodes becomes one node, until one
is left, the group's root. The roots of all groups, in the order of the groups, are the leaves of one more tree.

Aligned builders: a builder takes ARITY ** LEVELS leaves, the first at a multiple of that number, appends them one by one and writes
each node as soon as it is complete, so its log is a postorder sequence. Where a tree needs more builders, their roots are the
leaves of the builders of the next round. A node's place in such a log follows from its level, its index and the number of leaves
alone (`position`), so siblings are read by their addresses; complete subtrees keep theirs however many leaves are appended.

A proof's upper part is the same for all leaves of a builder. So proofs are handed down: from the tree of roots to each group, from
the builders of a round to those of the round before, one row for each builder, and only the last step makes a row per leaf.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import bucket_of, materialize, query, table

ARITY = 16
#: Levels that a builder makes above its leaves.
LEVELS = 3

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def digest(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def height(leaves: int) -> int:
    """Levels above the leaves."""
    levels = 0
    while leaves > 1:
        leaves, levels = -(-leaves // ARITY), levels + 1
    return levels


def position(level: int, index: int, leaves: int) -> int:
    """Where the log has a node: the nodes of its own and all earlier subtrees, and the higher nodes that are complete before it."""
    under = min(leaves, (index + 1) * ARITY**level)
    count = sum(-(-under // ARITY**below) for below in range(level + 1))
    while index := index // ARITY:
        count += index
    return count - 1


class Builder:
    """Appends leaves and writes nodes in the order in which they are complete, up to `top` levels above the leaves."""

    def __init__(self, top: int):
        self.log: list[str] = []
        self.top = top
        self.open: list[list[str]] = [[] for _ in range(top + 1)]

    def append(self, node: str, level: int = 0) -> None:
        self.log.append(node)
        self.open[level].append(node)
        if level < self.top and len(self.open[level]) == ARITY:
            self._close(level)

    def _close(self, level: int) -> None:
        children, self.open[level] = self.open[level], []
        self.append(digest("".join(children)), level + 1)

    def finish(self) -> list[str]:
        """Nodes at the right edge have what there is, even one child."""
        for level in range(self.top):
            if self.open[level]:
                self._close(level)
        return self.log


def segment(leaves: list[str], top: int) -> list[str]:
    """The log of a builder that makes `top` levels."""
    builder = Builder(top)
    for leaf in leaves:
        builder.append(leaf)
    return builder.finish()


def runs(log: list[str], leaves: int, top: int) -> list[list[str]]:
    """For each level below the top, the runs of nodes that become one, read from the log by their positions, each as one string."""
    out = []
    for level in range(top):
        width = -(-leaves // ARITY**level)
        nodes = [log[position(level, index, leaves)] for index in range(width)]
        out.append(["".join(nodes[at : at + ARITY]) for at in range(0, width, ARITY)])
    return out


def local_path(levels: list[list[str]], leaf: int) -> list[tuple[str, str]]:
    """(siblings at the left, siblings at the right) of a leaf and its ancestors below the builder's root."""
    out = []
    for row in levels:
        run, slot = row[leaf // ARITY], leaf % ARITY
        out.append((run[: 64 * slot], run[64 * slot + 64 :]))
        leaf //= ARITY
    return out


def fold(node: str, path: list[tuple[str, str]]) -> str:
    """The root that a leaf and its siblings give."""
    for left, right in path:
        node = digest(left + node + right)
    return node


def leaf_of(**changed: Column) -> Column:
    """The digest of a row's FIELDS: each `-` if null, else its UTF-8 byte count, `:` and its value. 32 bytes."""
    texts = [(changed.get(name, F.col(name))).cast("string") for name in FIELDS]
    parts = [F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in texts]
    return F.unhex(F.sha2(F.concat(*parts).cast("binary"), 256))


def ranked(rows: DataFrame, *order: str) -> DataFrame:
    """Rows with their rank within `tree` by `order`, from 0, and the number of rows of the tree. `order` is unique.

    Rows are sorted over the cluster by (tree, order), so a tree with a third of all rows is spread; ranks are those within a
    sorted partition plus the rows of the partitions before, which takes one row for each tree and partition.
    """
    ordered = rows.repartitionByRange("tree", *order).sortWithinPartitions("tree", *order)
    ordered = materialize(ordered.withColumn("place", F.monotonically_increasing_id()), "ordered")
    part = F.shiftright("place", 33).alias("part")
    held = ordered.groupBy("tree", part).agg(F.min("place").alias("first"), F.count("*").alias("held"))
    of_tree = Window.partitionBy("tree")
    so_far = of_tree.orderBy("part").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    shift = (F.sum("held").over(so_far) - F.col("held") - F.col("first")).alias("shift")
    held = held.select("tree", "part", shift, F.sum("held").over(of_tree).alias("leaves"))
    placed = ordered.withColumn("part", part).join(held, ["tree", "part"])
    return placed.withColumn("rank", F.col("place") + F.col("shift")).drop("place", "part", "shift", *order)


BUILT = "tree string, block long, leaves long, root binary, log binary"


@dataclass
class Tree:
    """Builders by round, the roots, and the levels of a builder. Round 0 also has its leaves' further columns in their order."""

    rounds: list[DataFrame]
    roots: DataFrame
    levels: int

    @property
    def span(self) -> int:
        """Leaves of a builder."""
        return ARITY**self.levels


def grow(nodes: DataFrame, payload: str, levels: int) -> Tree:
    """The trees of (tree, rank, leaves, node, ...); `payload` are the further columns, with their types, kept by round 0."""
    rounds, span = [], ARITY**levels
    names = [x.split()[0] for x in payload.split(",")]

    def build(group: pa.Table) -> pa.Table:
        group = group.sort_by("rank")
        of = group.column("leaves")[0].as_py()
        log = segment([x.as_py().hex() for x in group.column("node")], min(levels, height(of)))
        columns = {
            "tree": group.column("tree").slice(0, 1),
            "block": pa.array([group.column("rank")[0].as_py() // span], pa.int64()),
            "leaves": pa.array([of], pa.int64()),
            "root": pa.array([bytes.fromhex(log[-1])], pa.binary()),
            "log": pa.array([bytes.fromhex("".join(log))], pa.binary()),
        }
        for name in (x for x in names if x in group.column_names):
            flat = group.column(name).combine_chunks()
            columns[name] = pa.ListArray.from_arrays(pa.array([0, len(flat)], pa.int32()), flat)
        return pa.table(columns)

    while True:
        schema = BUILT if rounds else BUILT + "".join(f", {x.split()[0]} array<{x.split()[1]}>" for x in payload.split(","))
        blocks = nodes.withColumn("block", F.expr(f"rank div {span}")).groupBy("tree", "block")
        made = blocks.applyInArrow(build, schema)
        rounds.append(materialize(made, f"builders-{len(rounds)}"))
        unfinished = rounds[-1].filter(F.col("leaves") > span)
        if unfinished.isEmpty():
            break
        nodes = unfinished.select("tree", F.col("block").alias("rank"), F.expr(f"(leaves + {span - 1}) div {span}").alias("leaves"), F.col("root").alias("node"))
    done = [r.filter(F.col("leaves") <= span).select("tree", F.col("root").alias("node")) for r in rounds]
    roots = done[0]
    for more in done[1:]:
        roots = roots.unionByName(more)
    return Tree(rounds, roots, levels)


def _nodes(log: bytes) -> list[str]:
    text = log.hex()
    return [text[at : at + 64] for at in range(0, len(text), 64)]


def _builder_runs(row: dict, levels: int) -> tuple[list[list[str]], int]:
    """The runs of a builder and the number of its leaves."""
    leaves = min(ARITY**levels, row["leaves"] - row["block"] * ARITY**levels)
    return runs(_nodes(row["log"]), leaves, min(levels, height(row["leaves"]))), leaves


PATH = "array<struct<l:string,r:string>>"
_PATH = pa.list_(pa.struct([("l", pa.string()), ("r", pa.string())]))


def _with_paths(round_: DataFrame, span: int, from_above: DataFrame | None, of_roots: DataFrame) -> DataFrame:
    """A round's builders with `path`, that of the builder's root: of its tree's root if the builder is the only one."""
    last = round_.filter(F.col("leaves") <= span).join(of_roots, "tree")
    if from_above is None:
        return last
    return last.unionByName(round_.filter(F.col("leaves") > span).join(from_above, ["tree", "block"]))


def handed_down(tree: Tree, of_roots: DataFrame) -> DataFrame:
    """Round 0 with the path of each builder's root, from the (tree, path) of the trees' roots."""
    height_, span = tree.levels, tree.span

    def down(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                levels, leaves = _builder_runs(row, height_)
                paths = [[{"l": a, "r": b} for a, b in local_path(levels, k)] + row["path"] for k in range(leaves)]
                ranks = [row["block"] * span + k for k in range(leaves)]
                columns = [pa.array([row["tree"]] * leaves, pa.string()), pa.array(ranks, pa.int64()), pa.array(paths, _PATH)]
                yield pa.record_batch(columns, names=["tree", "block", "path"])

    above = None
    for round_ in reversed(tree.rounds[1:]):
        paths = _with_paths(round_, span, above, of_roots).select("tree", "block", "leaves", "log", "path")
        above = materialize(paths.mapInArrow(down, f"tree string, block long, path {PATH}"), "paths")
    return _with_paths(tree.rounds[0], span, above, of_roots)


def log_of(tree: Tree) -> DataFrame:
    """The append log of each tree: (tree, position, level, digest), a row for each node."""
    height_, span = tree.levels, tree.span

    def of_round(number: int):
        def nodes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for row in batch.to_pylist():
                    of, log, out = row["leaves"], _nodes(row["log"]), []
                    here = min(span, of - row["block"] * span)
                    for level in range(1 if number else 0, min(height_, height(of)) + 1):
                        for index in range(-(-here // ARITY**level)):
                            deep, at = level + height_ * number, index + row["block"] * span // ARITY**level
                            out.append((row["tree"], position(deep, at, row["of"]), deep, log[position(level, index, here)]))
                    yield pa.RecordBatch.from_pylist([dict(zip(("tree", "position", "level", "digest"), x, strict=True)) for x in out], schema)

        return nodes

    schema = pa.schema([("tree", pa.string()), ("position", pa.int64()), ("level", pa.int32()), ("digest", pa.string())])
    sizes = tree.rounds[0].filter("block = 0").select("tree", F.col("leaves").alias("of"))
    parts = [
        r.select("tree", "block", "leaves", "log").join(sizes, "tree").mapInArrow(of_round(k), "tree string, position long, level int, digest string")
        for k, r in enumerate(tree.rounds)
    ]
    out = parts[0]
    for more in parts[1:]:
        out = out.unionByName(more)
    return out


@dataclass
class Manifest:
    """The groups' trees (tree: `-` for a null group, else `=` and its name), and the tree of their roots."""

    groups: Tree
    top: Tree
    id_type: str


def build_manifest(docs: DataFrame, claimed: Column | None = None, levels: int = LEVELS) -> Manifest:
    """The manifest of (doc_id, source, lang, n_chars, text); `claimed` is a leaf to be checked in place of the row's own, if not null.

    Leaves of a source ascend by doc_id, null first; rows with the same doc_id by their digest, so the manifest depends on the rows
    alone. Any of the five columns may be null, which is not the same as empty; texts of any length are hashed whole; an empty
    table has no trees. Other columns are not read.
    """
    claimed = F.lit(None).cast("binary") if claimed is None else claimed
    group = F.coalesce(F.concat(F.lit("="), F.col("source").cast("string")), F.lit("-"))  # `-` sorts before `=`
    kind = docs.schema["doc_id"].dataType.simpleString()
    rows = docs.select(group.alias("tree"), "doc_id", leaf_of().alias("node"), claimed.alias("claimed"))
    rows = materialize(rows.withColumn("uid", F.monotonically_increasing_id()), "leaves")  # read again by range samples
    rows = rows.select("tree", "node", "claimed", "doc_id", F.col("doc_id").alias("o1"), F.col("node").alias("o2"), F.col("uid").alias("o3"))
    groups = grow(ranked(rows, "o1", "o2", "o3").withColumn("leaf", F.col("node")), f"doc_id {kind},leaf binary,claimed binary", levels)
    roots = groups.roots.select(F.lit("").alias("tree"), F.col("tree").alias("o1"), F.col("tree").alias("name"), "node")
    return Manifest(groups, grow(ranked(roots, "o1"), "name string", levels), kind)


def proofs(manifest: Manifest) -> DataFrame:
    """One row per document: doc_id, leaf, subroot, root, proof_sha256, folded_root, verified.

    The proof is the digest of all siblings from the leaf to the root. `folded_root` is what the claimed leaf (if there is one, else
    the leaf) gives with these siblings, and `verified` whether that is the root. Rows that are wholly equal have a row each.
    """
    nothing, height_ = F.array().cast(PATH), manifest.groups.levels
    top = manifest.top.roots.select("tree", F.hex("node").alias("root"), nothing.alias("path"))

    def of_groups(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                levels, leaves = _builder_runs(row, height_)
                paths = [[{"l": a, "r": b} for a, b in local_path(levels, k)] + row["path"] for k in range(leaves)]
                columns = [pa.array(row["name"], pa.string()), pa.array([row["root"].lower()] * leaves, pa.string()), pa.array(paths, _PATH)]
                yield pa.record_batch(columns, names=["tree", "root_hex", "path"])

    upper = handed_down(manifest.top, top.select("tree", "path"))
    upper = upper.drop("root").join(top.select("tree", "root"), "tree").select("block", "leaves", "log", "path", "name", "root")
    of_roots = materialize(upper.mapInArrow(of_groups, f"tree string, root_hex string, path {PATH}"), "group-paths")

    # the digests of a group and of the whole are on each builder's row
    subroots = manifest.groups.roots.select("tree", F.lower(F.hex("node")).alias("subroot")).join(of_roots.select("tree", "root_hex"), "tree")
    builders = handed_down(manifest.groups, of_roots.select("tree", "path")).join(subroots, "tree")

    names = ("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(batch.num_rows):
                row = {name: batch.column(name)[at].as_py() for name in ("log", "block", "leaves", "path", "subroot", "root_hex", "leaf", "claimed")}
                levels, leaves = _builder_runs(row, height_)
                above = [(x["l"], x["r"]) for x in row["path"]]
                proof, folded = [], []
                for k, (leaf, claim) in enumerate(zip(row["leaf"], row["claimed"], strict=True)):
                    path = local_path(levels, k) + above
                    proof.append(digest("".join(left + right for left, right in path)))
                    folded.append(fold((leaf if claim is None else claim).hex(), path))
                root = row["root_hex"]
                columns = [
                    batch.column("doc_id")[at].values,
                    pa.array([x.hex() for x in row["leaf"]], pa.string()),
                    pa.array([row["subroot"]] * leaves, pa.string()),
                    pa.array([root] * leaves, pa.string()),
                    pa.array(proof, pa.string()),
                    pa.array(folded, pa.string()),
                    pa.array(np.array(folded) == root, pa.bool_()),
                ]
                yield pa.record_batch(columns, names=list(names))

    schema = f"doc_id {manifest.id_type}, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean"
    return builders.select("block", "leaves", "log", "path", "subroot", "root_hex", "doc_id", "leaf", "claimed").mapInArrow(each, schema)


def lower_case(text: Column) -> Column:
    """A-Z in lower case; other letters stay."""
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def _sql(levels: int = 8) -> str:
    """Levels written out: SQL for groups of up to 16 ** levels rows, and as many groups."""
    encoded = " || ".join(f"coalesce(strlen(CAST({{{c}}} AS VARCHAR)) || ':' || CAST({{{c}}} AS VARCHAR), '-')" for c in FIELDS)
    own = encoded.format(**{c: c for c in FIELDS})
    low = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    changed = encoded.format(**{c: low if c == "text" else c for c in FIELDS})
    # crc32, bit by bit: -1 stands for a shift
    crc = (
        "xor(list_reduce(flatten(list_transform(string_split(coalesce(CAST(doc_id AS VARCHAR), ''), ''), lambda c: [CAST(ascii(c) AS BIGINT), -1, -1, -1, -1, -1, -1, -1, -1])), "
        "lambda a, b: CASE WHEN b >= 0 THEN xor(a, b) WHEN a % 2 = 1 THEN xor(a // 2, 3988292384) ELSE a // 2 END, CAST(4294967295 AS BIGINT)), 4294967295)"
    )
    parts = [
        f"""WITH a0 AS (
        SELECT row_number() OVER () AS uid, doc_id, source, sha256({own}) AS leaf,
               CASE WHEN {crc} % 5 = 0 THEN sha256({changed}) ELSE sha256({own}) END AS claim FROM documents),
    d0 AS (
        SELECT *, leaf AS node, claim AS folded, '' AS proof,
               row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf, uid) - 1 AS k,
               count(*) OVER (PARTITION BY source) AS n FROM a0)"""
    ]

    def climb(name: str, level: int, group: str) -> None:
        """A row of `name` with the node of the next level above it."""
        before, runs_ = f"{name}{level}", f"{name}r{level}"
        parts.append(
            f"""{runs_} AS (
        SELECT {group} AS g, k // 16 AS run, string_agg(node, '' ORDER BY k) AS run_text
        FROM (SELECT DISTINCT {group}, k, node FROM {before}) GROUP BY 1, 2),
    {name}{level + 1} AS (
        SELECT * EXCLUDE (run_text) REPLACE (
            CASE WHEN n > 1 THEN sha256(run_text) ELSE node END AS node,
            CASE WHEN n > 1 THEN sha256(left(run_text, 64 * (k % 16)) || folded || substr(run_text, 64 * (k % 16) + 65)) ELSE folded END AS folded,
            CASE WHEN n > 1 THEN proof || left(run_text, 64 * (k % 16)) || substr(run_text, 64 * (k % 16) + 65) ELSE proof END AS proof,
            CASE WHEN n > 1 THEN k // 16 ELSE k END AS k,
            CASE WHEN n > 1 THEN (n + 15) // 16 ELSE n END AS n)
        FROM (SELECT b.*, r.run_text FROM {before} b JOIN {runs_} r ON {group} IS NOT DISTINCT FROM r.g AND k // 16 = run))"""
        )

    for level in range(levels):
        climb("d", level, "source")
    parts.append(
        f"""t0 AS (
        SELECT * REPLACE (
            dense_rank() OVER (ORDER BY source NULLS FIRST) - 1 AS k, (SELECT count(*) FROM (SELECT DISTINCT source FROM a0)) AS n),
            node AS subroot, 0 AS whole FROM d{levels})"""
    )
    for level in range(levels):
        climb("t", level, "whole")
    select = f"""SELECT doc_id, leaf, subroot, node AS root, sha256(proof) AS proof_sha256, folded AS folded_root, folded = node AS verified
    FROM t{levels}"""
    return ",\n    ".join(parts) + "\n    " + select


@query("op13_merkle_manifest", _sql())
def merkle_manifest(spark: SparkSession, folder: str) -> DataFrame:
    """Every document's proof; those whose id's crc32 is divisible by five claim a text in lower case. A null id counts as empty there."""
    docs = table(spark, folder, "documents")
    tampered = F.when(bucket_of("doc_id", 5) == 0, leaf_of(text=lower_case(F.col("text"))))
    return proofs(build_manifest(docs, tampered))
