"""Near duplicates by fast similarity sketching, banding and exact verification.

1. Every document's distinct n-word shingles become 64-bit hashes; equal sets are one class.
2. A class's sketch has ``BANDS * ROWS`` coordinates.  In round i every shingle falls into a hashed bin with a hashed
   value, and a bin keeps its smallest (round, value); later rounds only fill bins that are still empty, and after as
   many rounds as there are bins, round by round all shingles go to one bin after the other, so every coordinate fills.
   Two sets agree in a coordinate with a chance equal to their similarity, and the number of agreeing coordinates is as
   concentrated as that of independent ones; a set of n shingles costs n hashes a round, mostly few rounds.
3. Bands of ``ROWS`` coordinates that agree put classes into one bucket.  A bucket's smallest class is its pivot; the
   pivot's block is all that share such a bucket with it, dealt in pieces of ``PIECE`` sets, each with the pivot.
4. Links are confirmed on the full sets: first every member against its pivot, whose links make components (``graph``);
   then, in blocks that still hold several components, the sets outside the pivot's component against the rest of the
   block, in pieces, skipping what is connected already.  So no bucket is ever paired out, and no link between two
   classes that share a bucket is lost.

A linked pair at exactly the threshold of 0.8 shares no band with a chance of (1 - 0.8**6)**42 = 3e-6, more similar
pairs with a smaller one; all copies and most near copies of a component have several ways to it.  Sets are known by
64-bit hashes, so chance collisions are possible in principle.

Defined cases: null and empty texts have the empty set, linked with nothing; fewer words than n make one shingle of the
whole sequence; repeated rows are members of the same class; a null id takes its component's smallest id (null where
there is none) and is kept only alone; an empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pitpanel.llm.graph import components
from pitpanel.llm.text import U64, Words, grams, mix, slices, stored, utf8, white_space_words

WORDS = 4
#: Two sets link when 100 * |intersection| >= PERCENT * |union|.
PERCENT = 80
BANDS, ROWS = 42, 6
#: Sets of a block that one group compares.
PIECE = 512
_SEED, _BAND = U64(0x9FB21C651E98DF25), U64(0xA24BAED4963EE407)
_EMPTY = U64((1 << 64) - 1)


def shingle_sets(column: pa.Array, n: int):
    """(first row, sizes, distinct sorted shingle hashes one text after the other) of slices of a text column."""
    data, offs = utf8(column)
    table = white_space_words()
    for start, end in slices(offs):
        for i in range(start, end, 1024):
            words = Words(data, offs, i, min(i + 1024, end), table, lower=True)
            every = grams(words.hash, n)
            parts = []
            for a, b in zip(words.first[:-1].tolist(), words.first[1:].tolist(), strict=True):
                own = np.sort(every[a : b - n + 1] if b - a >= n else grams(words.hash[a:b], b - a) if b > a else every[:0])
                parts.append(own[np.concatenate([[True], own[1:] != own[:-1]])] if len(own) else own)
            yield i, np.array([len(p) for p in parts], np.int64), np.concatenate(parts)


def signatures(sizes: np.ndarray, flat: np.ndarray) -> np.ndarray:
    """A hash of each set (of an empty one, anything)."""
    ends = np.cumsum(sizes)
    total = np.concatenate([np.zeros(1, U64), np.cumsum(flat, dtype=U64)])
    mixed = np.concatenate([np.zeros(1, U64), np.cumsum(mix(flat + U64(1)), dtype=U64)])
    first = mix(total[ends] - total[ends - sizes]) + sizes.astype(U64)
    return mix(first * U64(0x9E3779B97F4A7C15) + mix(mixed[ends] - mixed[ends - sizes])).view(np.int64)


def sketches(sizes: np.ndarray, flat: np.ndarray, t: int) -> np.ndarray:
    """The sketch of each set, a row of t numbers (round above value); of an empty set, all ones."""
    rows = len(sizes)
    out = np.full(rows * t, _EMPTY)
    row = np.repeat(np.arange(rows), sizes)
    left = sizes > 0
    seeds = mix(_SEED * np.arange(1, 2 * t + 1, dtype=U64))
    for k in range(2 * t):
        if not len(row):
            break
        h = mix(flat ^ seeds[k])
        bins = ((h >> U64(32)) * U64(t) >> U64(32)).astype(np.int64) if k < t else k - t
        np.minimum.at(out, row * t + bins, U64(k) << U64(32) | h & U64(0xFFFFFFFF))
        full = (out.reshape(rows, t) != _EMPTY).all(axis=1) & left
        if full.any():
            left &= ~full
            stay = left[row]
            row, flat = row[stay], flat[stay]
    return out.reshape(rows, t)


def bands(sketch: np.ndarray, b: int, r: int) -> np.ndarray:
    """A 64-bit bucket for each row and band."""
    parts = mix(sketch).reshape(len(sketch), b, r)
    key = np.broadcast_to(mix(_BAND * np.arange(1, b + 1, dtype=U64)), (len(sketch), b))
    for k in range(r):
        key = mix(key * U64(0x9E3779B97F4A7C15) + parts[:, :, k])
    return key.view(np.int64)


def sketched(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", n: int = WORDS, b: int = BANDS, r: int = ROWS) -> DataFrame:
    """``doc_id, n_shingles, class, buckets`` of each document; buckets: null where the task has met the class before, and of the empty set."""
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))

    def run(batches):
        met: set[int] = set()
        for batch in batches:
            for first, sizes, flat in shingle_sets(batch.column("text"), n):
                marks = signatures(sizes, flat)
                if len(met) > 1 << 18:
                    met = set()
                fresh = np.zeros(len(sizes), bool)
                for k, mark in enumerate(marks.tolist()):
                    if sizes[k] and mark not in met:
                        met.add(mark)
                        fresh[k] = True
                found = bands(sketches(sizes[fresh], flat[np.repeat(fresh, sizes)], b * r), b, r)
                ends = np.concatenate([[0], np.cumsum(np.where(fresh, b, 0))])
                buckets = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(found.ravel()), mask=pa.array(~fresh))
                yield pa.RecordBatch.from_arrays([batch.column("doc_id").slice(first, len(sizes)), pa.array(sizes, pa.int64()), pa.array(marks, mask=sizes == 0), buckets], names=["doc_id", "n_shingles", "class", "buckets"])

    return rows.mapInArrow(run, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, n_shingles long, class long, buckets array<long>")


def candidates(first: DataFrame) -> DataFrame:
    """``pivot, class``, stored: every class that shares a bucket with a smaller one, with the buckets' smallest classes."""
    keys = first.where("buckets IS NOT NULL").select("class", F.explode("buckets").alias("key"))
    # counts combine before the shuffle; as a table of its own, the join can split hot buckets
    pivots = stored(keys.groupBy("key").agg(F.min("class").alias("pivot"), F.max("class").alias("top")).where("pivot != top").select("key", "pivot"), "pivots")
    return stored(keys.join(pivots, "key").where("class != pivot").select("pivot", "class").distinct(), "pairs")


def full_sets(docs: DataFrame, first: DataFrame, pairs: DataFrame, doc_id: str = "doc_id", text: str = "text", n: int = WORDS) -> DataFrame:
    """``class, size, tokens`` of the classes in ``pairs``, from the texts of one document each (few classes may come twice)."""
    wanted = pairs.select("class").unionByName(pairs.select(F.col("pivot").alias("class"))).distinct()
    ids = first.where("class IS NOT NULL").groupBy("class").agg(F.min("doc_id").alias("id")).join(wanted, "class")
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")).where(F.col("text").isNotNull())
    # by id, so that rows of one id meet in a task; classes of null ids are found by their marks
    chosen = rows.join(ids.hint("merge"), F.col("doc_id").eqNullSafe(F.col("id"))).select("class", "text")

    def run(batches):
        met: set[int] = set()
        for batch in batches:
            classes = batch.column("class").to_numpy()
            for start, sizes, flat in shingle_sets(batch.column("text"), n):
                marks, ends = signatures(sizes, flat), np.cumsum(sizes)
                keep = []
                for k in np.flatnonzero((marks == classes[start : start + len(sizes)]) & (sizes > 0)).tolist():
                    if (mark := int(marks[k])) not in met:
                        met.add(mark)
                        keep.append(k)
                if len(met) > 1 << 18:
                    met = set()
                yield pa.RecordBatch.from_arrays([pa.array(marks[keep]), pa.array(sizes[keep], pa.int64()), pa.array([flat[ends[k] - sizes[k] : ends[k]].tobytes() for k in keep], pa.binary())], names=["class", "size", "tokens"])

    return chosen.mapInArrow(run, "class long, size long, tokens binary")


def _groups(batches, keys: list[str]):
    """Tables of the rows of each key; the rows come sorted by key."""
    rest = None
    for batch in batches:
        rows = pa.Table.from_batches([batch]) if rest is None else pa.concat_tables([rest, pa.Table.from_batches([batch])])
        at = np.stack([rows[k].to_numpy() for k in keys])
        edges = [0, *(np.flatnonzero((at[:, 1:] != at[:, :-1]).any(axis=0)) + 1).tolist()]
        for a, b in zip(edges[:-1], edges[1:], strict=True):
            yield rows.slice(a, b - a)
        rest = rows.slice(edges[-1])
    if rest is not None and rest.num_rows:
        yield rest


def _linked(shared: np.ndarray, size: int, sizes: np.ndarray, percent: int) -> np.ndarray:
    return 100 * shared >= percent * (size + sizes - shared)


def _edges(a: list[int], b: list[int]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])


def pivot_links(pairs: DataFrame, sets: DataFrame, percent: int = PERCENT, piece: int = PIECE) -> DataFrame:
    """The confirmed links ``a, b`` among ``pivot, class``."""
    count = stored(pairs.groupBy("pivot").agg(F.ceil(F.count("*") / F.lit(piece)).cast("int").alias("pieces")), "pieces")
    others = pairs.join(count, "pivot").select("pivot", F.pmod(F.xxhash64("class"), "pieces").cast("int").alias("piece"), "class")
    cores = count.select("pivot", F.explode(F.sequence(F.lit(0), F.col("pieces") - 1)).alias("piece"), F.col("pivot").alias("class"))
    met = others.unionByName(cores).join(sets, "class").select("pivot", "piece", "class", "size", "tokens")

    def run(batches):
        for group in _groups(batches, ["pivot", "piece"]):
            pivot, marks, sizes = group["pivot"][0].as_py(), group["class"].to_numpy(), group["size"].to_numpy()
            own = np.flatnonzero(marks == pivot)
            rest = np.flatnonzero((marks != pivot) & (100 * sizes >= percent * sizes[own[0]]) & (percent * sizes <= 100 * sizes[own[0]])) if len(own) else own
            if not len(rest):
                continue
            core = np.frombuffer(group["tokens"][int(own[0])].as_py(), U64)
            flat = np.frombuffer(b"".join(group["tokens"][k].as_py() for k in rest.tolist()), U64)
            inside = core[np.minimum(np.searchsorted(core, flat), len(core) - 1)] == flat
            shared = np.add.reduceat(inside, np.cumsum(sizes[rest]) - sizes[rest], dtype=np.int64)
            found = marks[rest[_linked(shared, len(core), sizes[rest], percent)]].tolist()
            if found:
                yield _edges([pivot] * len(found), found)

    return met.repartition("pivot", "piece").sortWithinPartitions("pivot", "piece").mapInArrow(run, "a long, b long")


def block_links(pairs: DataFrame, sets: DataFrame, roots: DataFrame, percent: int = PERCENT, piece: int = PIECE) -> DataFrame:
    """Links within blocks that still hold several components (``v, root``: those of ``pivot_links``), as far as they connect them."""
    of = roots.select(F.col("v").alias("class"), "root")
    named = pairs.join(of, "class", "left").select("pivot", "class", F.coalesce("root", "class").alias("root"))
    named = named.join(of.select(F.col("class").alias("pivot"), F.col("root").alias("core")), "pivot", "left").select("pivot", "class", "root", (F.col("root") != F.coalesce("core", "pivot")).alias("stray"))
    named = stored(named, "named")
    pieces = lambda c: F.ceil(c / F.lit(piece)).cast("int")
    about = named.groupBy("pivot").agg(F.count("*").alias("m"), F.sum(F.col("stray").cast("int")).alias("s")).where("s > 0 AND m > 1")
    about = stored(about.select("pivot", pieces(F.col("s")).alias("rows"), pieces(F.col("m")).alias("columns")), "mixed")
    mixed = named.join(about, "pivot")
    own = lambda c: F.pmod(F.xxhash64("class"), c).cast("int")
    each = lambda c: F.explode(F.sequence(F.lit(0), F.col(c) - 1))
    probes = mixed.where("stray").select("pivot", own("rows").alias("i"), each("columns").alias("j"), "class", "root", F.lit(True).alias("probe"))
    members = mixed.select("pivot", each("rows").alias("i"), own("columns").alias("j"), "class", "root", F.lit(False).alias("probe"))
    met = probes.unionByName(members).join(sets, "class").select("pivot", "i", "j", "class", "root", "probe", "size", "tokens")

    def run(batches):
        for group in _groups(batches, ["pivot", "i", "j"]):
            marks, part, sizes = group["class"].to_numpy(), group["root"].to_numpy().copy(), group["size"].to_numpy()
            ask = group["probe"].to_numpy(zero_copy_only=False)
            if not ask.any() or (part == part[0]).all():
                continue
            tokens, rank = np.unique(np.frombuffer(b"".join(group["tokens"].to_pylist()), U64), return_inverse=True)
            ends = np.cumsum(sizes)
            starts, inside, a, b = ends - sizes, np.zeros(len(tokens), bool), [], []
            for x in np.flatnonzero(ask).tolist():
                open_ = (part != part[x]) & ~ask & (100 * sizes >= percent * sizes[x]) & (percent * sizes <= 100 * sizes[x])
                if not open_.any():
                    continue
                inside[rank[starts[x] : ends[x]]] = True
                shared = np.add.reduceat(inside[rank], starts, dtype=np.int64)
                inside[rank[starts[x] : ends[x]]] = False
                for y in np.flatnonzero(open_ & _linked(shared, sizes[x], sizes, percent)).tolist():
                    if part[y] != part[x]:
                        a.append(int(marks[x]))
                        b.append(int(marks[y]))
                        part[part == part[y]] = part[x]
            if a:
                yield _edges(a, b)

    return met.repartition("pivot", "i", "j").sortWithinPartitions("pivot", "i", "j").mapInArrow(run, "a long, b long")


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", *, n: int = WORDS, percent: int = PERCENT, b: int = BANDS, r: int = ROWS, piece: int = PIECE) -> DataFrame:
    """``doc_id, n_shingles, class, component_id, kept`` of each document; component_id: the smallest doc_id reachable by links."""
    first = stored(sketched(docs, doc_id, text, n, b, r), "sketched")
    pairs = candidates(first)
    sets = stored(full_sets(docs, first, pairs, doc_id, text, n), "sets")
    links = stored(pivot_links(pairs, sets, percent, piece), "links")
    more = stored(block_links(pairs, sets, components(links), percent, piece), "links")
    roots = components(links.unionByName(more))
    least = first.where("class IS NOT NULL").groupBy("class").agg(F.min("doc_id").alias("id"))
    least = stored(least.join(roots.select(F.col("v").alias("class"), "root"), "class", "left").select("class", "id", F.coalesce("root", "class").alias("root")), "classes")
    best = stored(least.groupBy("root").agg(F.min("id").alias("component_id")), "components")
    by_class = stored(least.join(best, "root").select("class", "component_id"), "components")
    named = first.drop("buckets").join(by_class, "class", "left").withColumn("component_id", F.coalesce("component_id", "doc_id"))
    return named.select("doc_id", "n_shingles", "class", "component_id", F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"))
