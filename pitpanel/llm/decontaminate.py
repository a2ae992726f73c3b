"""Benchmark decontamination with suffix arrays of the training texts.

Each task sorts the suffixes of its own training words into suffix arrays (one shard per slice of text) and
binary-searches every benchmark suffix in them; suffixes whose leading words leave the benchmark's vocabulary before
any window could fit cannot match and are left out of the array.  The benchmark is a stated query set: it is sent in
blocks of bounded size, one scan step per block, and the corpus is never shuffled.

Defined cases: null or empty text has no words; an item without words is ignored; a null item id is listed as the
empty string; repeated documents are judged each on its own, repeated item ids count once; an empty benchmark marks
nothing.  Extra columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pitpanel.llm.text import Words, alone, alphanumeric_words, slices, utf8

WINDOW = 10
#: Most characters of benchmark text in one broadcast block (one longer item makes a longer block).
BLOCK_CHARS = 16_000_000


class Block:
    """Windows of some benchmark items, as sequences of word numbers (1 ...), ready for binary search."""

    def __init__(self, items: list[tuple[str | None, str | None]], window: int):
        self.window = window
        texts = pa.array([t for _, t in items], pa.large_string())
        data, offs = utf8(texts)
        words = Words(data, offs, 0, len(items), alphanumeric_words(), lower=True)
        self.vocabulary = np.unique(words.hash)
        ids = (np.searchsorted(self.vocabulary, words.hash) + 1).astype(np.uint32)
        keys, lengths, owners, starts = [], [], [], []
        for k in range(len(items)):
            own = ids[words.first[k] : words.first[k + 1]]
            size = min(window, len(own))
            if size:
                view = np.zeros((len(own) - size + 1, window), np.uint32)
                view[:, :size] = np.lib.stride_tricks.sliding_window_view(own, size)
                keys.append(view)
                lengths.append(np.full(len(view), size))
                owners.append(np.full(len(view), k))
                starts.append(np.arange(len(view)))
        self.names = [name or "" for name, _ in items]
        if not keys:
            self.keys, self.lengths, self.use_item, self.use_start = np.zeros(0, f"S{4 * window}"), *(np.zeros(0, np.int64) for _ in range(3))
            self.use_from = np.zeros(1, np.int64)
            return
        key, length = sortable(np.concatenate(keys)), np.concatenate(lengths)
        both = key.astype(f"S{4 * window}")
        order = np.lexsort((length, both))  # equal windows together; of every window its uses (item, start)
        both, length = both[order], length[order]
        fresh = np.ones(len(both), bool)
        fresh[1:] = (both[1:] != both[:-1]) | (length[1:] != length[:-1])
        self.keys, self.lengths = both[fresh], length[fresh]
        self.use_from = np.append(np.flatnonzero(fresh), len(both))
        self.use_item, self.use_start = np.concatenate(owners)[order], np.concatenate(starts)[order]
        top = np.frombuffer(b"".join(k.ljust(4 * window, b"\0") for k in self.keys.tolist()), np.uint8).reshape(-1, 4 * window).copy()
        top[np.arange(4 * window)[None, :] >= 4 * self.lengths[:, None]] = 0xFF
        self.ceilings = np.ascontiguousarray(top).view(f"S{4 * window}").ravel()
        head = np.array([int.from_bytes(k[:4].ljust(4, b"\0"), "big") for k in self.keys.tolist()])
        self.least = np.full(len(self.vocabulary) + 1, np.iinfo(np.int64).max)  # words that a window from here needs
        np.minimum.at(self.least, head, self.lengths)
        self.seen = np.zeros(1 << 16, bool)
        self.seen[(self.vocabulary >> np.uint64(48)).astype(np.int64)] = True

    def occurrences(self, words: Words) -> tuple[np.ndarray, np.ndarray]:
        """(window, first word) of every window that occurs in the words."""
        none = np.zeros(0, np.int64)
        if not len(self.keys) or not len(words.hash):
            return none, none
        ids = np.zeros(len(words.hash), np.uint32)
        likely = np.flatnonzero(self.seen[(words.hash >> np.uint64(48)).astype(np.int64)])
        at = np.minimum(np.searchsorted(self.vocabulary, words.hash[likely]), len(self.vocabulary) - 1)
        known = self.vocabulary[at] == words.hash[likely]
        ids[likely[known]] = at[known] + 1
        stops = np.union1d(np.flatnonzero(ids == 0), words.first[1:])
        at = np.flatnonzero(ids)
        run = stops[np.searchsorted(stops, at, "right")] - at
        keep = run >= self.least[ids[at]]
        at, run = at[keep], np.minimum(run[keep], self.window)
        if not len(at):
            return none, none
        step = np.arange(self.window)
        suffix = np.where(step < run[:, None], ids[np.minimum(at[:, None] + step, len(ids) - 1)], 0).astype(np.uint32)
        keys = sortable(suffix)
        order = np.argsort(keys, kind="stable")  # the suffix array, sorted as deep as a window reaches
        keys, at = keys[order], at[order]
        low, high = np.searchsorted(keys, self.keys, "left"), np.searchsorted(keys, self.ceilings, "right")
        found = np.flatnonzero(high > low)
        window = np.repeat(found, (high - low)[found])
        if not len(window):
            return none, none
        return window, at[np.concatenate([np.arange(low[w], high[w]) for w in found])]

    def uses(self, window: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For windows: the index into them and into use_item / use_start, one for each item and place."""
        count = self.use_from[window + 1] - self.use_from[window]
        which = np.repeat(np.arange(len(window)), count)
        return which, np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count) + self.use_from[window][which]


def sortable(ids: np.ndarray) -> np.ndarray:
    """Rows of word numbers as byte strings in the same order."""
    return np.ascontiguousarray(ids.astype(">u4")).view(f"S{4 * ids.shape[1]}").ravel()


def blocks(benchmark: DataFrame, item: str, text: str, window: int, most: int = BLOCK_CHARS) -> Iterator[Block]:
    """The benchmark in blocks of about ``most`` characters."""
    rows = benchmark.select(F.col(item).cast("string").alias("item"), F.col(text).alias("text")).where(F.length("text") > 0)
    total = rows.agg(F.sum(F.length("text").cast("long"))).first()[0] or 0
    n = max(1, math.ceil(total / most))
    for k in range(n):
        part = rows if n == 1 else rows.where(F.pmod(F.xxhash64("item", "text"), F.lit(n)) == k)
        yield Block([tuple(r) for r in part.distinct().collect()], window)


def mark(docs: DataFrame, benchmark: DataFrame, *, doc_id: str = "doc_id", text: str = "text", item: str = "item_id", item_text: str = "text", window: int = WINDOW, carry: tuple[str, ...] = (), block_chars: int = BLOCK_CHARS) -> DataFrame:
    """Per document: ``doc_id, n_words, n_hit, items`` (ids of the items with occurring windows, sorted), and the columns of ``carry``."""
    context = docs.sparkSession.sparkContext
    out = docs.select(*dict.fromkeys((doc_id, text, *carry)), F.lit(0).cast("long").alias("n_words"), F.lit(0).cast("long").alias("n_hit"), F.lit(None).cast("binary").alias("_hit"), F.array().cast("array<string>").alias("items"))
    schema = out.schema
    for block in blocks(benchmark, item, item_text, window, block_chars):
        sent = context.broadcast(block)

        def step(batches, sent=sent):
            block, table = sent.value, alphanumeric_words()
            for batch in batches:
                data, offs = utf8(batch.column(text))
                n_words, n_hit, hits = [], [], []
                items = batch.column("items").to_pylist()
                before = batch.column("_hit").to_pylist()
                for i, j in slices(offs):
                    words = Words(data, offs, i, j, table, lower=True)
                    window, at = block.occurrences(words)
                    change = np.zeros(len(words.hash) + 1, np.int32)
                    np.add.at(change, at, 1)
                    if len(at):
                        np.add.at(change, at + block.lengths[window], -1)
                    hit = np.cumsum(change[:-1]) > 0
                    which, use = block.uses(window)
                    pairs = np.unique(np.stack([words.row[at[which]], block.use_item[use]]), axis=1) if len(use) else np.zeros((2, 0), int)
                    for row, k in zip(*pairs.tolist(), strict=True):
                        items[i + row].append(block.names[k])
                    for row in range(j - i):
                        own = hit[words.first[row] : words.first[row + 1]]
                        if before[i + row] is not None:
                            own = own | np.unpackbits(np.frombuffer(before[i + row], np.uint8))[: len(own)].astype(bool)
                        n_words.append(len(own))
                        n_hit.append(int(own.sum()))
                        hits.append(np.packbits(own).tobytes() if n_hit[-1] else None)
                new = {"n_words": pa.array(n_words, pa.int64()), "n_hit": pa.array(n_hit, pa.int64()), "_hit": pa.array(hits, pa.binary()), "items": pa.array([sorted(set(x)) for x in items], pa.list_(pa.string()))}
                yield pa.RecordBatch.from_arrays([new.get(c, batch.column(c)) for c in batch.schema.names], names=batch.schema.names)

        out = out.mapInArrow(alone(step), schema)
    return out.drop("_hit", *({text} - {doc_id, *carry}))


def matches(docs: DataFrame, benchmark: DataFrame, *, doc_id: str = "doc_id", text: str = "text", item: str = "item_id", item_text: str = "text", window: int = WINDOW, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """Every longest verbatim match: ``doc_id, item_id, doc_start, item_start, n_words`` (places in words).

    A match cannot be extended by a word on either side; matches shorter than a window are not reported.
    """
    context = docs.sparkSession.sparkContext
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    found = None
    for block in blocks(benchmark, item, item_text, window, block_chars):
        sent = context.broadcast(block)

        def step(batches, sent=sent):
            block, table = sent.value, alphanumeric_words()
            for batch in batches:
                data, offs = utf8(batch.column("text"))
                for i, j in slices(offs):
                    words = Words(data, offs, i, j, table, lower=True)
                    window, at = block.occurrences(words)
                    if not len(at):
                        continue
                    which, use = block.uses(window)
                    at, item, start, size = at[which], block.use_item[use], block.use_start[use], block.lengths[window][which]
                    order = np.lexsort((at, at - start, item, words.row[at]))
                    at, item, start, size = at[order], item[order], start[order], size[order]
                    row = words.row[at]
                    fresh = np.ones(len(at), bool)  # a window continues the match of the window one word before
                    fresh[1:] = (item[1:] != item[:-1]) | (row[1:] != row[:-1]) | (at[1:] != at[:-1] + 1) | (start[1:] != start[:-1] + 1)
                    first = np.flatnonzero(fresh)
                    last = np.append(first[1:], len(at)) - 1
                    yield pa.RecordBatch.from_arrays([
                        batch.column("doc_id").take(pa.array(row[first] + i)), pa.array([block.names[k] for k in item[first]], pa.string()),
                        pa.array(at[first] - words.first[row[first]], pa.int64()), pa.array(start[first], pa.int64()), pa.array(at[last] - at[first] + size[first], pa.int64()),
                    ], names=["doc_id", "item_id", "doc_start", "item_start", "n_words"])

        part = rows.mapInArrow(alone(step), f"doc_id {kind}, item_id string, doc_start long, item_start long, n_words long")
        found = part if found is None else found.unionByName(part)
    return found


def remove_contaminated(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """The documents in which no benchmark window occurs, with all their columns."""
    names = docs.columns
    keep = mark(docs.select(*(F.col(f"`{c}`").alias(f"c{k}") for k, c in enumerate(names))), benchmark, carry=tuple(f"c{k}" for k in range(len(names))), doc_id=f"c{names.index(options.pop('doc_id', 'doc_id'))}", text=f"c{names.index(options.pop('text', 'text'))}", **options)
    return keep.where("n_hit = 0").select(*(F.col(f"c{k}").alias(c) for k, c in enumerate(names)))


def report(marked: DataFrame) -> DataFrame:
    """The digest per document of ``mark``'s rows."""
    return marked.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"), F.sha2(F.concat_ws(",", F.array_sort("items")).cast("binary"), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"))
