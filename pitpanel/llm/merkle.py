"""A Merkle manifest of a dataset: one root for all rows, a proof for every row, and folding of (possibly changed) rows.

H is the lower-case hex SHA-256; a node is the H of its up to three consecutive children's hex digests.  The rows of a
source are the leaves of its tree, in ascending id order; the sources' subroots, in order of the source, are the leaves
of the last tree, whose root stands for the whole dataset.

1. Leaves are computed by Spark's own functions and stored (digests only, no texts).  One range-partitioned, sorted pass
   over the digests numbers them: the runs of a source in a partition are counted, and prefix sums over those counts give
   each leaf its place, so a source of any size spreads over tasks.
2. Upwards: ``3 ** LEVELS`` consecutive nodes of a tree (a superblock) become one node, superblock by superblock, until
   every tree has one.  A tier has ``3 ** LEVELS`` times fewer nodes than the tier below.
3. Downwards: the nodes of a superblock and the one outer path above it (the siblings of its ancestors, bottom up) are
   cogrouped in ``applyInPandas``.  A group reduces its nodes, joins their inner siblings with the outer path and hands
   the paths to the tier below; in the lowest tier it builds the proofs and folds the rows' digests up to the root.

Groups hold at most ``3 ** LEVELS`` nodes and one path, whatever the sizes of sources.  Every tier is stored, so a lost
executor costs its tasks only.

Defined cases: null columns are ``-`` in a leaf, empty texts ``0:``; equal ids of a source are ordered by their leaves, so
repeated rows have equal leaves and places of their own; null ids come first, null sources form a source of their own
before the empty name; a lone row of a lone source is its own root, with an empty proof; an empty table gives no rows;
extra columns are ignored.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from pitpanel.llm.text import stored

FAN = 3
#: Levels of a superblock: 729 nodes.
LEVELS = 6
COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")
#: The tree number of the tree of sources.
SOURCES = -1


def field(column: str | Column) -> Column:
    """``-`` for null, else UTF-8 byte count, ``:``, value."""
    value = (F.col(column) if isinstance(column, str) else column).cast("string")
    return F.coalesce(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value), F.lit("-"))


def leaf(columns: dict[str, str] | None = None, text: Column | None = None) -> Column:
    """Digest of a row; ``columns``: names of the five columns where they differ; ``text``: another text."""
    names = {c: c for c in COLUMNS} | (columns or {})
    parts = [field(text if c == "text" and text is not None else names[c]) for c in COLUMNS]
    return F.sha2(F.concat(*parts).cast("binary"), 256)


def without_line_feeds(doc_id: str = "doc_id", text: str = "text") -> Column:
    """The tampered text: line feeds go where 2 divides the crc32 of the decimal id."""
    odd = F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 2, F.lit(1))
    return F.when(odd == 0, F.translate(F.col(text), "\n", "")).otherwise(F.col(text))


def _digest(children: list[str]) -> str:
    return hashlib.sha256("".join(children).encode()).hexdigest()


def levels_of(digests: list[str], levels: int) -> list[list[str]]:
    """The nodes of the given number of levels above consecutive nodes, which come first."""
    out = [digests]
    for _ in range(levels):
        below = out[-1]
        out.append([_digest(below[k : k + FAN]) for k in range(0, len(below), FAN)])
    return out


def depth(n: int) -> int:
    """Levels above n leaves."""
    d = 0
    while n > 1:
        n, d = -(-n // FAN), d + 1
    return d


def _numbered(leaves: DataFrame, partitions: int) -> DataFrame:
    """Leaves as nodes: ``doc_id, digest, changed, tree, idx, n`` (tree: the source's number, idx: the place, n: leaves of the source).

    ``leaves`` are stored; ids go on as text, as pandas has no null integers.
    """
    order = ["source", "doc_id", "leaf", "row"]
    dealt = leaves.withColumn("row", F.monotonically_increasing_id()).repartitionByRange(partitions, *order).sortWithinPartitions(*order).drop("row")

    def place(batches):
        part, run, at, last = TaskContext.get().partitionId(), -1, 0, object()
        for batch in batches:
            source = batch.column("source")
            codes = source.dictionary_encode(null_encoding="encode")
            number = codes.indices.to_numpy()
            edges = np.flatnonzero(np.diff(number)) + 1
            runs, places = np.empty(len(number), np.int32), np.empty(len(number), np.int64)
            for a, b in zip([0, *edges.tolist()], [*edges.tolist(), len(number)], strict=True):
                if a == b:
                    continue
                name = codes.dictionary[int(number[a])].as_py()
                if name != last:
                    run, at, last = run + 1, 0, name
                runs[a:b], places[a:b] = run, np.arange(at, at + b - a)
                at += b - a
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(np.full(len(number), part, np.int32)), pa.array(runs), pa.array(places)], names=[*batch.schema.names, "part", "run", "place"])

    schema = StructType([*dealt.schema.fields, *StructType.fromDDL("part int, run int, place long").fields])
    placed = stored(dealt.mapInArrow(place, schema), "placed")
    runs = placed.groupBy("part", "run").agg(F.first("source").alias("source"), F.count("*").alias("rows"))
    # a source's runs: one a partition; the first of them names the source
    own = Window.partitionBy("source")
    runs = stored(runs.select("*", F.min("part").over(own).alias("home"), F.sum("rows").over(own).alias("n"), F.coalesce(F.sum("rows").over(own.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("before")), "runs")
    first = runs.where("part = home").select("source", "home", (F.row_number().over(Window.partitionBy("home").orderBy("source")) - 1).alias("k"))
    homes = first.groupBy("home").agg(F.count("*").alias("sources"))  # a row a partition at most
    homes = homes.select("home", F.coalesce(F.sum("sources").over(Window.orderBy("home").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("base"))
    trees = first.join(F.broadcast(homes), "home").select(F.col("source").alias("s"), (F.col("base") + F.col("k")).cast("long").alias("tree"))
    starts = runs.join(trees, F.col("source").eqNullSafe(F.col("s"))).select("part", "run", "tree", "before", "n")
    nodes = placed.drop("source").join(starts, ["part", "run"]).select(F.col("doc_id").cast("string"), F.col("leaf").alias("digest"), "changed", "tree", (F.col("before") + F.col("place")).alias("idx"), "n")
    return stored(nodes, "nodes")


def _up(nodes: DataFrame, levels: int) -> list[DataFrame]:
    """Tiers ``tree, idx, n, digest`` above the given nodes, which come first; the last holds one node for each tree that is left.

    A tree leaves with the tier in which it has one node.
    """
    size = FAN**levels

    def reduce(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("idx")
        n = int(rows["n"].iloc[0])
        top = levels_of(rows["digest"].tolist(), min(levels, depth(n)))[-1]
        return pd.DataFrame({"tree": [key[0]], "idx": [key[1]], "n": [-(-n // size)], "digest": top})

    tiers = [nodes]
    while (most := tiers[-1].agg(F.max("n")).first()[0]) is not None and most > 1:
        below = tiers[-1].where("n > 1").select("tree", F.col("idx"), "n", "digest", F.floor(F.col("idx") / size).alias("block"))
        tiers.append(stored(below.groupBy("tree", "block").applyInPandas(reduce, "tree long, idx long, n long, digest string"), "tier"))
    return tiers


def _siblings(levels: list[list[str]], k: int) -> tuple[str, list[str]]:
    """Of node k of the lowest level: its place in every run below the top, and the others of the runs, bottom up."""
    steps, beside = [], []
    for nodes in levels[:-1]:
        first, own = k - k % FAN, k % FAN
        run = nodes[first : first + FAN]
        steps.append(f"{own}{len(run) - 1}")
        beside += run[:own] + run[own + 1 :]
        k //= FAN
    return "".join(steps), beside


def fold(digest: str, steps: str, siblings: str) -> str:
    """The root that a digest and its path lead to."""
    at = 0
    for k in range(0, len(steps), 2):
        own, others = int(steps[k]), int(steps[k + 1])
        cut = at + 64 * own
        end = at + 64 * others
        digest = hashlib.sha256((siblings[at:cut] + digest + siblings[cut:end]).encode()).hexdigest()
        at = end
    return digest


_PATHS = "tree long, block long, steps string, siblings string, subroot string, root string"


def _grouped_with(nodes: DataFrame, paths: DataFrame, levels: int, finish, schema: str) -> DataFrame:
    """The cogroup of superblocks and outer paths; ``finish(rows, found, outer)`` makes the rows, found: (steps, siblings) of each."""
    size = FAN**levels
    inner = nodes.withColumn("block", F.floor(F.col("idx") / size))

    def exchange(rows: pd.DataFrame, outer: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("idx")
        outer = outer.iloc[0]
        built = levels_of(rows["digest"].tolist(), min(levels, depth(int(rows["n"].iloc[0]))))
        found = []
        for k in range(len(rows)):
            steps, beside = _siblings(built, k)
            found.append((steps + outer["steps"], "".join(beside) + outer["siblings"]))
        return finish(rows, found, outer)

    return inner.groupBy("tree", "block").cogroup(paths.groupBy("tree", "block")).applyInPandas(exchange, schema)


def _down(tiers: list[DataFrame], tops: DataFrame, levels: int) -> DataFrame:
    """Outer paths of the superblocks of the lowest tier; ``tops``: ``tree, steps, siblings, subroot, root`` above each tree."""
    size = FAN**levels

    def above(tier: DataFrame, lower: DataFrame | None) -> DataFrame:
        ends = tier.where((F.col("n") <= size) & (F.col("idx") == 0)).select("tree")  # trees that this tier's only superblock ends
        own = tops.join(ends, "tree").select("tree", F.lit(0).cast("long").alias("block"), "steps", "siblings", "subroot", "root")
        return own if lower is None else own.unionByName(lower)

    def finish(rows, found, outer):
        return pd.DataFrame({"tree": rows["tree"].to_numpy(), "block": rows["idx"].to_numpy(), "steps": [s for s, _ in found], "siblings": [b for _, b in found], "subroot": outer["subroot"], "root": outer["root"]})

    paths = None
    for tier in reversed(tiers[1:-1]):  # the last holds single nodes only
        # a tree of one node in this tier ends in the tier below, with its own top
        tier = tier.where("n > 1")
        paths = stored(_grouped_with(tier, above(tier, paths), levels, finish, _PATHS), "paths")
    return stored(above(tiers[0], paths), "paths")


def _tops(tiers: list[DataFrame]) -> DataFrame:
    """``tree, digest`` of every tree's top node."""
    out = None
    for tier in tiers:
        one = tier.where("n = 1").select("tree", "digest")
        out = one if out is None else out.unionByName(one)
    return out


def manifest(docs: DataFrame, *, columns: dict[str, str] | None = None, tampered: Column | None = None, levels: int = LEVELS, partitions: int | None = None) -> DataFrame:
    """``doc_id, leaf, subroot, root, steps, siblings, folded_root, verified`` of every row.

    siblings: the proof, 64 hex digits a sibling, bottom up and left to right; steps: for each level the row's place
    among the run's nodes and the number of the others.  ``tampered``: the text to fold instead of the row's own.
    """
    names = {c: c for c in COLUMNS} | (columns or {})
    own = leaf(names)
    seen = own if tampered is None else leaf(names, tampered)
    leaves = stored(docs.select(F.col(names["doc_id"]).alias("doc_id"), F.col(names["source"]).alias("source"), own.alias("leaf"), F.nullif(seen, own).alias("changed")), "leaves")
    nodes = _numbered(leaves, partitions or int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    tiers = _up(nodes, levels)
    subroots = stored(_tops(tiers), "subroots")
    over = _up(stored(subroots.select(F.lit(SOURCES).cast("long").alias("tree"), F.col("tree").alias("idx"), F.lit(subroots.count()).cast("long").alias("n"), "digest"), "sources"), levels)
    none = F.lit("")
    root = _tops(over).select("tree", none.alias("steps"), none.alias("siblings"), F.col("digest").alias("subroot"), F.col("digest").alias("root"))

    def finish_source(rows, found, outer):
        return pd.DataFrame({"tree": rows["idx"].to_numpy(), "steps": [s for s, _ in found], "siblings": [b for _, b in found], "subroot": rows["digest"].to_numpy(), "root": outer["root"]})

    tops = stored(_grouped_with(over[0], _down(over, root, levels), levels, finish_source, "tree long, steps string, siblings string, subroot string, root string"), "tops")

    def finish(rows, found, outer):
        folded = [fold(c or d, *path) for d, c, path in zip(rows["digest"], rows["changed"], found, strict=True)]
        return pd.DataFrame({
            "doc_id": rows["doc_id"].to_numpy(), "leaf": rows["digest"].to_numpy(), "subroot": outer["subroot"], "root": outer["root"],
            "steps": [s for s, _ in found], "siblings": [b for _, b in found], "folded_root": folded, "verified": [f == outer["root"] for f in folded],
        })

    schema = "doc_id string, leaf string, subroot string, root string, steps string, siblings string, folded_root string, verified boolean"
    out = _grouped_with(nodes, _down(tiers, tops, levels), levels, finish, schema)
    return out.withColumn("doc_id", F.col("doc_id").cast(leaves.schema["doc_id"].dataType))
