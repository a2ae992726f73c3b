"""N-gram Jaccard self-join of documents by prefix trees, exact at a threshold.

1. Every document's distinct n-word shingles become 64-bit hashes; equal sets are one class with one representative.
2. Shingles are ordered globally from rare to frequent (``recurrence`` counts them).  A set most of whose shingles occur
   nowhere else cannot have a partner and leaves; of the others, any two linked sets share a shingle of their prefixes.
3. The smallest set with a prefix shingle is that shingle's pivot; all sets of one pivot form a block, so linked sets
   meet in a block.  A block's sets are stored in a trie whose edges carry runs of shingles in the block's global order;
   a probe walks it level by level, sharing the overlap of common paths, and leaves subtrees whose remaining length (or
   sizes) cannot reach the threshold, or that hold only sets already connected to it.
4. A block too large for a task is dealt in pieces, each with the pivot.  What links to the pivot is connected; the
   others (strays) are compared with the sets of all pieces that the triangle inequality of the Jaccard distance leaves
   possible, piece by piece.
5. Links become components (``graph``).

Sets and shingles are known by 64-bit hashes (shingles in the trie by at least 50 bits): chance collisions are possible
in principle, about one pair of sets in 10**19.

Defined cases: null and empty texts have the empty set, linked with nothing; fewer words than n make one shingle of the
whole sequence; repeated rows are members of the same class; a null id takes its component's smallest id; an empty
table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pitpanel.llm.graph import components
from pitpanel.llm.recurrence import SCHEMA, Packer, bins_for, recurring
from pitpanel.llm.text import U64, Words, alone, grams, mix, slices, stored, utf8, white_space_words

WORDS = 5
#: Two sets link when 100 * |intersection| >= PERCENT * |union|.
PERCENT = 75
#: Blocks of more sets are split.
BLOCK = 512


def _sets(column: pa.Array, n: int):
    """(row, distinct shingle hashes in order) of each text."""
    data, offs = utf8(column)
    table = white_space_words()
    for i, j in slices(offs):
        words = Words(data, offs, i, j, table, lower=True)
        every = grams(words.hash, n)
        for row in range(j - i):
            a, b = words.first[row], words.first[row + 1]
            own = every[a : b - n + 1] if b - a >= n else grams(words.hash[a:b], int(b - a)) if b > a else every[:0]
            own = np.sort(own)
            yield i + row, own[np.concatenate([[True], own[1:] != own[:-1]])] if len(own) else own


def _signature(own: np.ndarray) -> int:
    """A hash of a non-empty set."""
    parts = np.array([own.sum(dtype=U64), np.bitwise_xor.reduce(mix(own + U64(1))), len(own)], U64)
    return int(grams(parts, 3)[0].view(np.int64))


def shingle_classes(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", n: int = WORDS) -> DataFrame:
    """``doc_id, mark, n_shingles, class`` of each document; equal sets have equal classes (null: the empty set); mark: a hash of the text."""
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.xxhash64(text).alias("mark"), F.col(text).alias("text"))

    def run(batches):
        for batch in batches:
            sizes, marks = [], []
            for _, own in _sets(batch.column("text"), n):
                sizes.append(len(own))
                marks.append(_signature(own) if len(own) else None)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("mark"), pa.array(sizes, pa.int64()), pa.array(marks, pa.int64())], names=["doc_id", "mark", "n_shingles", "class"])

    return rows.mapInArrow(alone(run), f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, mark long, n_shingles long, class long")


def candidate_sets(docs: DataFrame, text: str = "text", n: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """``class, n, tokens`` of the sets of which at least ``percent`` of the shingles occur elsewhere; tokens: those shingles from rare to frequent, packed."""
    bins = bins_for(docs.sparkSession)

    def pack(batches):
        packer, inside = Packer(bins, place=False), set()
        for batch in batches:
            for _, own in _sets(batch.column(0), n):
                if not len(own) or (mark := _signature(own)) in inside:
                    continue
                if not packer.total:
                    inside = set()
                inside.add(mark)
                yield from packer.add(np.array([mark, len(own)], np.int64).tobytes(), own)
        yield from packer.end()

    def per_unit(header, owner, hashes, counts, _):
        about = np.frombuffer(header, np.int64).reshape(-1, 2)
        order = np.lexsort((hashes, counts, owner))
        owner, hashes = owner[order], hashes[order]
        shared = np.bincount(owner, minlength=len(about))
        first = np.cumsum(shared) - shared
        keep = np.flatnonzero((100 * shared >= percent * about[:, 1]) & (shared > 0))
        yield pa.RecordBatch.from_arrays([pa.array(about[keep, 0]), pa.array(about[keep, 1]), pa.array([hashes[first[k] : first[k] + shared[k]].tobytes() for k in keep], pa.binary())], names=["class", "n", "tokens"])

    return recurring(docs.select(text).mapInArrow(alone(pack), SCHEMA), bins, False, per_unit, "class long, n long, tokens binary").dropDuplicates(["class"])


def _need(total, percent: int):
    """Least intersection of two linked sets with so many elements together."""
    return -(-percent * total // (100 + percent))


class Trie:
    """Token sets in a trie: level by level, the nodes' runs of ``width`` ranks, parents, and ranges of sets below."""

    def __init__(self, sets: list[np.ndarray], sizes: np.ndarray):
        tokens, rank, count = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
        place = np.empty(len(tokens), np.int64)
        place[np.lexsort((tokens, -count))] = np.arange(len(tokens))  # frequent first: most paths shared
        ranked, at = place[rank], 0
        rows = []
        for s in sets:
            rows.append(np.sort(ranked[at : at + len(s)]))
            at += len(s)
        self.order = sorted(range(len(rows)), key=lambda k: rows[k].astype(">u4").tobytes())
        self.rows = [rows[k] for k in self.order]
        self.sizes = sizes[self.order]
        self.tokens = len(tokens)
        self.width = 256 if len(rows) <= 8 else 32
        lengths = np.array([len(r) for r in self.rows])
        common = np.zeros(len(rows), np.int64)  # ranks shared with the set before
        for k in range(1, len(rows)):
            m = min(lengths[k], lengths[k - 1])
            differ = np.flatnonzero(self.rows[k][:m] != self.rows[k - 1][:m])
            common[k] = differ[0] if len(differ) else m
        self.levels = []
        node_of = np.zeros(len(rows), np.int64)
        alive = np.arange(len(rows))
        depth = 0
        while len(alive):
            # a set starts a node unless it shares the whole run (and what precedes) with the set before it
            start = np.ones(len(alive), bool)
            if len(alive) > 1:
                between = np.array([common[a + 1 : b + 1].min() for a, b in zip(alive[:-1], alive[1:], strict=True)])
                reach = np.minimum(depth + self.width, np.maximum(lengths[alive[1:]], lengths[alive[:-1]]))
                start[1:] = between < reach
            node = np.cumsum(start) - 1
            heads = alive[start]
            run = np.full((len(heads), self.width), self.tokens, np.int64)
            for k, h in enumerate(heads):
                part = self.rows[h][depth : depth + self.width]
                run[k, : len(part)] = part
            low = heads
            ends = np.append(np.flatnonzero(start)[1:], len(alive)) - 1
            high = alive[ends] + 1
            last = np.array([self.rows[h][min(depth + self.width, lengths[h]) - 1] for h in heads])
            left = np.maximum.reduceat(lengths[alive], np.flatnonzero(start)) - (depth + self.width)
            least = np.minimum.reduceat(self.sizes[alive], np.flatnonzero(start))
            done = lengths[alive] <= depth + self.width
            self.levels.append((run, node_of[heads], low, high, last, np.maximum(left, 0), least, alive[done], node[done]))
            node_of[alive] = node
            alive = alive[~done]
            depth += self.width

    def links(self, x: int, wanted: np.ndarray, percent: int) -> np.ndarray:
        """The sets among ``wanted`` (a mask) that link to set x (both by their place in the trie)."""
        return self.probe(self.rows[x], self.sizes[x], wanted, percent)

    def probe(self, ranks: np.ndarray, size: int, wanted: np.ndarray, percent: int) -> np.ndarray:
        wanted = wanted & (100 * self.sizes >= percent * size) & (percent * self.sizes <= 100 * size)
        if not wanted.any():
            return np.zeros(0, np.int64)
        inside = np.zeros(self.tokens + 1, bool)
        inside[ranks] = True
        below = np.concatenate([[0], np.cumsum(wanted)])
        overlap, ok, out = np.zeros(1, np.int64), np.ones(1, bool), []
        for run, parent, low, high, last, left, least, done, at in self.levels:
            alive = np.flatnonzero(ok[parent] & (below[high] > below[low]))
            if not len(alive):
                break
            now = np.zeros(len(run), np.int64)
            now[alive] = overlap[parent[alive]] + inside[run[alive]].sum(axis=1)
            rest = len(ranks) - np.searchsorted(ranks, last[alive], "right")
            ok = np.zeros(len(run), bool)
            ok[alive] = now[alive] + np.minimum(rest, left[alive]) >= _need(size + least[alive], percent)
            overlap = now
            end = done[ok[at] & wanted[done]]
            if len(end):
                end_at = at[ok[at] & wanted[done]]
                out.append(end[overlap[end_at] >= _need(size + self.sizes[end], percent)])
        return np.concatenate(out) if out else np.zeros(0, np.int64)


def block_links(marks: np.ndarray, sizes: np.ndarray, sets: list[np.ndarray], percent: int, probes: np.ndarray | None = None) -> list[tuple[int, int]]:
    """Edges that connect what is linked within a block; ``probes``: mask of the sets to compare with all (else every set)."""
    trie = Trie(sets, sizes)
    marks = marks[trie.order]
    ask = np.ones(len(marks), bool) if probes is None else probes[trie.order]
    part = np.arange(len(marks))
    for x in np.flatnonzero(ask):
        wanted = part != part[x]
        if probes is None:
            wanted[: x + 1] = False
        for y in trie.links(x, wanted, percent):
            if part[y] != part[x]:
                part[part == part[y]] = part[x]
    out = []
    for p in np.unique(part):
        own = np.sort(marks[part == p])
        out += [(int(own[0]), int(m)) for m in own[1:]]
    return out


def _grouped(batches, keys: list[str]):
    """Column arrays of each run of equal keys in sorted rows."""
    held = None
    for batch in batches:
        rows = pa.Table.from_batches([batch])
        rows = rows if held is None else pa.concat_tables([held, rows])
        ids = np.stack([rows[k].to_numpy() for k in keys])
        edge = np.flatnonzero((ids[:, 1:] != ids[:, :-1]).any(axis=0)) + 1
        cuts = [0, *edge.tolist()]
        for a, b in zip(cuts[:-1], cuts[1:], strict=True):
            yield rows.slice(a, b - a)
        held = rows.slice(cuts[-1])
    if held is not None and len(held):
        yield held


def _edges(group: pa.Table, percent: int, probes: np.ndarray | None = None) -> list[tuple[int, int]]:
    sets = [np.frombuffer(x.as_py(), U64) for x in group["tokens"]]
    return block_links(group["class"].to_numpy(), group["n"].to_numpy(), sets, percent, probes)


def _found(pairs: list[tuple[int, int]], far) -> pa.RecordBatch:
    """far: 0 for edges."""
    return pa.RecordBatch.from_arrays([pa.array([p[0] for p in pairs], pa.int64()), pa.array([p[1] for p in pairs], pa.int64()), pa.array(np.broadcast_to(np.asarray(far, float), len(pairs)), pa.float64())], names=["a", "b", "far"])


def set_links(sets: DataFrame, percent: int = PERCENT, block: int = BLOCK) -> DataFrame:
    """Edges ``a, b`` between classes that connect exactly the linked ones; ``sets`` as of ``candidate_sets`` (stored)."""

    def prefixes(batches):
        for batch in batches:
            n, marks = batch.column("n").to_numpy(), batch.column("class").to_numpy()
            tokens, owners = [], []
            for k, packed in enumerate(batch.column("tokens")):
                own = np.frombuffer(packed.as_py(), np.int64)
                length = int(n[k]) + _floor_need(int(n[k]), percent)
                own = own[: max(0, length - (int(n[k]) - len(own)))]  # shingles without a second place come first
                tokens.append(own)
                owners.append(np.full(len(own), marks[k]))
            if tokens:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(tokens)), pa.array(np.concatenate(owners))], names=["token", "class"])

    prefix = sets.mapInArrow(alone(prefixes), "token long, class long")
    pivots = prefix.groupBy("token").agg(F.min("class").alias("pivot"), F.max("class").alias("top")).where("pivot != top").drop("top")
    pairs = stored(prefix.join(pivots, "token").where("class != pivot").select("pivot", "class").distinct(), "pairs")
    pieces = pairs.groupBy("pivot").agg(F.ceil(F.count("*") / F.lit(block)).cast("int").alias("pieces"))
    # the pivot goes to every piece of its block
    others = pairs.join(pieces, "pivot").select("pivot", F.pmod(F.xxhash64("class"), F.col("pieces")).cast("int").alias("piece"), "pieces", "class")
    cores = pieces.select("pivot", F.explode(F.sequence(F.lit(0), F.col("pieces") - 1)).alias("piece"), "pieces", F.col("pivot").alias("class"))
    met = others.unionByName(cores).join(sets, "class").select("pivot", "piece", "pieces", "class", "n", "tokens")

    def within(batches):
        for group in _grouped(batches, ["pivot", "piece"]):
            edges = _edges(group, percent)
            yield _found(edges, 0)
            if group["pieces"][0].as_py() > 1:
                yield _found(*_distances(group))

    found = stored(met.repartition("pivot", "piece").sortWithinPartitions("pivot", "piece").mapInArrow(alone(within), "a long, b long, far double"), "links")
    edges = found.where("far = 0").select("a", "b")
    reach = 1 - percent / 100 + 1e-9
    star = found.where("far > 0").select(F.col("a").alias("pivot"), F.col("b").alias("class"), "far")
    if star.where(F.col("far") > reach).isEmpty():
        return edges
    return edges.unionByName(_stray_links(star, sets, reach, percent, block))


def _distances(group: pa.Table) -> tuple[list[tuple[int, int]], np.ndarray]:
    """(pivot, class) and Jaccard distance of a block's sets from its pivot."""
    pivot, marks, n = group["pivot"][0].as_py(), group["class"].to_pylist(), group["n"].to_pylist()
    sets = [np.frombuffer(x.as_py(), U64) for x in group["tokens"]]
    core = marks.index(pivot)
    own = [k for k in range(len(marks)) if marks[k] != pivot]
    same = [len(np.intersect1d(sets[core], sets[k], assume_unique=True)) for k in own]
    return [(pivot, marks[k]) for k in own], np.array([1 - s / (n[core] + n[k] - s) for s, k in zip(same, own, strict=True)])


def _floor_need(n: int, percent: int) -> int:
    return 1 - -(-percent * n // 100)


def _stray_links(star: DataFrame, sets: DataFrame, reach: float, percent: int, block: int) -> DataFrame:
    """Links of the sets that their pivot does not link to, in bounded pieces; ``star``: ``pivot, class, far``."""
    near = F.col("far") <= reach
    # a set so near the pivot that no stray can be within reach of it is left out
    about = star.groupBy("pivot").agg(F.min(F.when(~near, F.col("far"))).alias("nearest"), F.count(F.when(~near, 1)).alias("rows")).where("rows > 0")
    all_of = star.join(about, "pivot").where(F.col("far") >= F.col("nearest") - reach)
    counts = all_of.groupBy("pivot").agg(F.count("*").alias("columns"))
    count = lambda c: F.ceil(F.col(c) / F.lit(block)).cast("int")
    all_of = all_of.join(counts, "pivot").select("pivot", "class", "far", count("rows").alias("rows"), count("columns").alias("columns"))
    own_piece = lambda c: F.pmod(F.xxhash64("class"), F.col(c)).cast("int")
    # every piece of strays meets every piece of members; a stray is a member too
    as_probe = all_of.where(~near).select("pivot", "class", F.lit(True).alias("probe"), own_piece("rows").alias("i"), F.explode(F.sequence(F.lit(0), F.col("columns") - 1)).alias("j"))
    as_member = all_of.select("pivot", "class", F.lit(False).alias("probe"), F.explode(F.sequence(F.lit(0), F.col("rows") - 1)).alias("i"), own_piece("columns").alias("j"))
    met = as_probe.unionByName(as_member).groupBy("pivot", "i", "j", "class").agg(F.max("probe").alias("probe")).join(sets, "class").select("pivot", "i", "j", "class", "probe", "n", "tokens")

    def between(batches):
        for group in _grouped(batches, ["pivot", "i", "j"]):
            ask = group["probe"].to_numpy(zero_copy_only=False).astype(bool)
            if ask.any():
                yield _found(_edges(group, percent, ask), 0)

    return met.repartition("pivot", "i", "j").sortWithinPartitions("pivot", "i", "j").mapInArrow(alone(between), "a long, b long, far double").select("a", "b")


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", n: int = WORDS, percent: int = PERCENT, block: int = BLOCK) -> DataFrame:
    """``doc_id, mark, n_shingles, class, root, component_id`` of each document.

    component_id: the smallest doc_id reachable by links; root: a class that names the component, also where ids repeat
    or are null (null: the empty set); mark: a hash of the text.
    """
    sets = stored(candidate_sets(docs, text, n, percent), "sets")
    roots = components(set_links(sets, percent, block))
    classes = stored(shingle_classes(docs, doc_id, text, n), "classes")
    least = classes.where("class IS NOT NULL").groupBy("class").agg(F.min("doc_id").alias("first_id"))
    least = stored(least.join(roots.select(F.col("v").alias("class"), "root"), "class", "left").withColumn("root", F.coalesce("root", "class")), "classes")
    best = stored(least.groupBy("root").agg(F.min("first_id").alias("component_id")), "components")  # a table of its own: the join can split a hot root
    by_class = stored(least.join(best, "root").select("class", "root", "component_id"), "components")
    return classes.join(by_class, "class", "left").select("doc_id", "mark", "n_shingles", "class", "root", F.coalesce("component_id", "doc_id").alias("component_id"))


def keep_one(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """One document of each component: that with the smallest id.

    Documents are told apart by id and text, so a row that only shares its id with a near copy of another stays.  Null
    ids come last; of equal ids in a component the text decides (by its class and hash), and of fully repeated rows one
    stays.  Documents without words are in no component and all stay.
    """
    near = near_duplicates(docs, doc_id, text, **options).where("class IS NOT NULL")
    texts = stored(near.groupBy("root", "doc_id", "class", "mark").agg(F.count("*").alias("n")), "texts")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "class", "mark", "n")).alias("first")
    best = stored(texts.groupBy("root").agg(first).select(F.col("root").alias("of"), "first.*"), "best")
    same = F.col("k.doc_id").eqNullSafe(F.col("b.doc_id")) & (F.col("k.class") == F.col("b.class")) & (F.col("k.mark") == F.col("b.mark"))
    rest = texts.alias("k").join(best.alias("b"), F.col("k.root") == F.col("b.of")).where(~same)
    key = lambda t, q="": t.select(F.col(f"{q}doc_id").alias("_of_id"), F.col(f"{q}mark").alias("_of_mark"))
    is_of = F.col(f"`{doc_id}`").eqNullSafe(F.col("_of_id")) & (F.xxhash64(F.col(f"`{text}`")) == F.col("_of_mark"))
    kept = docs.join(key(rest, "k."), is_of, "left_anti")
    repeated = key(best.where("n > 1"))
    if repeated.isEmpty():
        return kept
    one = kept.join(repeated, is_of, "left_semi").withColumn("_mark_of_text", F.xxhash64(F.col(f"`{text}`"))).dropDuplicates([doc_id, "_mark_of_text"])
    return kept.join(repeated, is_of, "left_anti").unionByName(one.drop("_mark_of_text"))
