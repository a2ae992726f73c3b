"""Removal of repeated passages with sharded Aho-Corasick automata of the recurring phrases.

A window is ``size`` consecutive words of one document; a word goes if a window that covers it also starts earlier in
the corpus (smaller document, or earlier in the same one), judged on the input.

1. Every window has an anchor: its smallest hashed 6-word phrase.  Equal windows have equal anchors, so only windows
   whose anchor occurs twice in the corpus can recur (``recurrence`` finds these, a seventh of the positions).
2. The passages around recurring anchors go to the anchors' shards, equal ones of a task combined.  A shard confirms word
   by word what recurs: whole passages that occur more than once, and windows that different passages share.  It compiles
   Aho-Corasick automata of both and streams every passage through: where something recurs is known from the automata
   alone.  Then all places of a window but the earliest are late.
3. An anchor with very many occurrences is spread over several shards; the earliest occurrences that these find for the
   same phrase meet in one more small exchange.
4. The located occurrences are joined to the documents.

The documents are shuffled once (both joins use the same exchange).

Documents are known by (id, hash of the text): of equal ids the text's hash decides the order, and fully repeated rows
are one document, each row getting its result.  Defined cases: null text has no words; a null id sorts first; ids are
integers; an empty table gives no rows; other columns are kept, but for any called n_words, n_removed or kept, which
the results replace.
"""

from __future__ import annotations

import hashlib

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pitpanel.llm.recurrence import SCHEMA, Packer, bins_for, recurring
from pitpanel.llm.text import U64, Words, alone, grams, slices, sliding_min, utf8, white_space_words

SIZE = 20
ANCHOR = 6
#: Occurrences of an anchor that one shard takes; more are spread.
HOT = 5000
#: Passages of one automaton.
PASSAGES = 20_000
NO_ID = -(1 << 63)
OCCURRENCE = np.dtype([("id", "<i8"), ("text", "<i8"), ("start", "<i4")])


def anchors(words: Words, size: int, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of every window: its first word, its anchor's hash, its anchor's place."""
    low, at = sliding_min(grams(words.hash, k), size - k + 1)
    n = max(0, len(words.hash) - size + 1)
    start = np.flatnonzero(words.row[:n] == words.row[size - 1 : size - 1 + n])
    return start, low[start], at[start]


def _rows(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """Columns c0 ... of the documents, the text being ``_text``, and ``_id``, ``_hash``: the text goes through the exchange once."""
    names = docs.columns
    out = docs.select(*(F.col(f"`{c}`").alias("_text" if c == text else f"c{k}") for k, c in enumerate(names)))
    id_ = F.col(out.columns[names.index(doc_id)])
    return out.select("*", F.coalesce(id_.cast("long"), F.lit(NO_ID)).alias("_id"), F.xxhash64("_text").alias("_hash"))


def _recurring_anchors(rows: DataFrame, size: int, k: int) -> DataFrame:
    """``_id, _hash, anchors, counts`` of the documents that have recurring anchors."""
    bins = bins_for(rows.sparkSession)

    def pack(batches):
        packer, table = Packer(bins, place=False), white_space_words()
        for batch in batches:
            data, offs = utf8(batch.column("_text"))
            keys = np.stack([batch.column("_id").to_numpy(), batch.column("_hash").to_numpy()], axis=1)
            for i, j in slices(offs):
                words = Words(data, offs, i, j, table, lower=False)
                start, low, at = anchors(words, size, k)
                if not len(start):
                    continue
                fresh = np.concatenate([[True], at[1:] != at[:-1]])
                low, row = low[fresh], words.row[start[fresh]]
                cuts = np.flatnonzero(np.diff(row, prepend=-1))
                for a, b in zip(cuts, np.append(cuts[1:], len(row)), strict=True):
                    yield from packer.add(keys[i + row[a]].tobytes(), low[a:b])
        yield from packer.end()

    def per_unit(header, owner, hashes, counts, _):
        if not len(owner):  # nothing of the unit recurs
            return
        about = np.frombuffer(header, np.int64).reshape(-1, 2)
        order = np.lexsort((hashes, owner))
        owner, hashes, counts = owner[order], hashes[order], counts[order]
        fresh = np.ones(len(owner), bool)
        fresh[1:] = (owner[1:] != owner[:-1]) | (hashes[1:] != hashes[:-1])
        owner, hashes, counts = owner[fresh], hashes[fresh], counts[fresh]
        cuts = np.flatnonzero(np.diff(owner.astype(np.int64), prepend=-1))
        ends = np.append(cuts[1:], len(owner))
        own = owner[cuts].astype(np.int64)
        yield pa.RecordBatch.from_arrays([pa.array(about[own, 0]), pa.array(about[own, 1]), pa.array([hashes[a:b].tobytes() for a, b in zip(cuts, ends, strict=True)], pa.binary()), pa.array([counts[a:b].tobytes() for a, b in zip(cuts, ends, strict=True)], pa.binary())], names=["_id", "_hash", "anchors", "counts"])

    return recurring(rows.select("_id", "_hash", "_text").mapInArrow(alone(pack), SCHEMA), bins, False, per_unit, "_id long, _hash long, anchors binary, counts binary")


def _passages(rows: DataFrame, known: DataFrame, size: int, k: int, hot: int) -> DataFrame:
    """The passages around recurring anchors: ``anchor, salt, hot, passage, found`` (packed occurrences)."""
    drop = U64(64 - 40 - (bins_for(rows.sparkSession).bit_length() - 1))

    def cut(batches):
        table = white_space_words()
        for batch in batches:
            data, offs = utf8(batch.column("_text"))
            ids, texts = batch.column("_id").to_numpy(), batch.column("_hash").to_numpy()
            marks, counts = batch.column("anchors"), batch.column("counts")
            found: dict[tuple[int, int, bytes], list] = {}
            for i, j in slices(offs):
                words = Words(data, offs, i, j, table, lower=False)
                raw = words.data.tobytes()
                start, low, at = anchors(words, size, k)
                low = (low >> drop) << drop
                row = words.row[start]
                edges = np.searchsorted(row, np.arange(j - i + 1))
                for r in range(j - i):
                    own = np.frombuffer(marks[i + r].as_py(), U64)
                    a, b = edges[r], edges[r + 1]
                    if a == b:
                        continue
                    place = np.minimum(np.searchsorted(own, low[a:b]), len(own) - 1)
                    hit = own[place] == low[a:b]
                    if not hit.any():
                        continue
                    times = np.frombuffer(counts[i + r].as_py(), np.uint32)[place]
                    begin = np.flatnonzero(hit & np.concatenate([[True], at[a + 1 : b] != at[a : b - 1]]))
                    # windows of one anchor are consecutive
                    after = np.flatnonzero(np.concatenate([at[a + 1 : b] != at[a : b - 1], [True]]))
                    until = after[np.searchsorted(after, begin)]
                    s, e = start[a + begin], start[a + until]
                    spans = zip(low[a + begin].view(np.int64).tolist(), times[begin].tolist(), words.starts[s].tolist(), words.ends[e + size - 1].tolist(), (s - words.first[r]).tolist(), strict=True)
                    for anchor, count, x, y, first in spans:
                        found.setdefault((anchor, count, raw[x:y]), []).append((ids[i + r], texts[i + r], first))
            if found:
                seed = int(ids[0]) * 31 + len(ids)
                salts = [(seed + anchor) % (-(-count // hot)) if count > hot else 0 for anchor, count, _ in found]
                yield pa.RecordBatch.from_arrays([
                    pa.array([x[0] for x in found], pa.int64()), pa.array(salts, pa.int32()), pa.array([x[1] > hot for x in found], pa.bool_()),
                    pa.array([x[2] for x in found], pa.binary()), pa.array([np.array(x, OCCURRENCE).tobytes() for x in found.values()], pa.binary()),
                ], names=["anchor", "salt", "hot", "passage", "found"])

    return rows.join(known, ["_id", "_hash"]).mapInArrow(alone(cut), "anchor long, salt int, hot boolean, passage binary, found binary")


LOCATED = "key long, more long, _id long, _hash long, start int, windows int"


def _letter(k: int) -> str:
    return chr(k + 1 if k < 0xD7FF else k + 0x801)


def shared_phrases(texts: list[str], size: int) -> set[str]:
    """The phrases of ``size`` letters that occur in two places of the texts."""
    seen, out = set(), set()
    for text in texts:
        for k in range(len(text) - size + 1):
            phrase = text[k : k + size]
            (out if phrase in seen else seen).add(phrase)
    return out


def automaton(phrases: set[str], passages: set[str]) -> ahocorasick.Automaton:
    """Of phrases (numbered) and whole passages (by their length); what is both has both."""
    out = ahocorasick.Automaton()
    number = {p: n for n, p in enumerate(phrases)}
    for p in phrases | passages:
        out.add_word(p, (number.get(p, -1), len(p) if p in passages else 0))
    if len(out):
        out.make_automaton()
    return out


def locate(passages: list[tuple[bytes, ...]], repeated: list[bool], shares: list[bool], size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """What recurs, streamed through one automaton: (passage, offset, phrase) of the phrases of ``size`` words that the
    passages marked in ``shares`` have in common, and the passages marked in ``repeated`` that were found whole."""
    letters: dict[bytes, str] = {}  # every word as one letter
    for words in passages:
        for w in words:
            if w not in letters:
                letters[w] = _letter(len(letters))
    texts = ["".join([letters[w] for w in words]) for words in passages]
    recurring_ = automaton(shared_phrases([t for t, s in zip(texts, shares, strict=True) if s], size), {t for t, r in zip(texts, repeated, strict=True) if r})
    passage, offset, phrase, whole = [], [], [], []
    if len(recurring_):
        for n, text in enumerate(texts):
            last = len(text) - 1
            for end, (number, length) in recurring_.iter(text):
                if number >= 0 and shares[n]:
                    passage.append(n)
                    offset.append(end - size + 1)
                    phrase.append(number)
                if end == last and length == last + 1:
                    whole.append(n)
    return tuple(np.array(x, np.int64) for x in (passage, offset, phrase, whole))


def _located(rows: list[tuple], size: int) -> pa.RecordBatch:
    """Rows (anchor, salt, hot, passage, found) of whole groups: what recurs for certain (key 0), and the earliest places of hot phrases."""
    variants: dict[tuple, int] = {}
    packed, of = [], []
    for anchor, salt, hot, passage, found in rows:
        words = tuple(passage.split())
        of.append(variants.setdefault((anchor, salt, hot, words), len(variants)))
        packed.append(found)
    every = np.frombuffer(b"".join(packed), OCCURRENCE)
    variant = np.repeat(of, [len(p) // OCCURRENCE.itemsize for p in packed])
    order = np.lexsort((every["start"], every["text"], every["id"], variant))
    every, variant = every[order], variant[order]
    head = np.concatenate([[True], variant[1:] != variant[:-1]])
    first = every[head]  # of each variant, in order
    same = (every == first[variant]) & ~head  # a repeated row
    later = np.flatnonzero(~head & ~same)  # occurrences of a passage after its first
    names = list(variants)
    again = np.bincount(variant[later], minlength=len(names)) > 0
    groups: dict[tuple, list[int]] = {}
    for n, v in enumerate(names):
        groups.setdefault(v[:2], []).append(n)
    asked = np.array([n for g in groups.values() for n in g if len(g) > 1 or again[n]], np.int64)
    more = []
    if len(asked):
        shares = [len(groups[names[n][:2]]) > 1 for n in asked]
        passage, offset, phrase, whole = locate([names[n][3] for n in asked], again[asked].tolist(), shares, size)
        passage, whole = asked[passage], asked[whole]
        # a passage that was found whole is late in every occurrence after its first
        found = np.zeros(len(names), bool)
        found[whole] = True
        which = later[found[variant[later]]]
        windows = np.array([len(v[3]) - size + 1 for v in names])[variant[which]]
        more.append([np.zeros(len(which), np.int64), np.zeros(len(which), np.int64), every["id"][which], every["text"][which], every["start"][which], windows])
        # of the first occurrences, a phrase's earliest place stays
        at = first[passage]
        place = at["start"] + offset
        order = np.lexsort((place, at["text"], at["id"], phrase))
        phrase, at, place = phrase[order], at[order], place[order]
        lead = np.concatenate([[True], phrase[1:] != phrase[:-1]]) if len(phrase) else np.zeros(0, bool)
        source = np.flatnonzero(lead)[np.cumsum(lead) - 1]
        late = (at["id"] != at["id"][source]) | (at["text"] != at["text"][source]) | (place != place[source])
        more.append([np.zeros(late.sum(), np.int64), np.zeros(late.sum(), np.int64), at["id"][late], at["text"][late], place[late], np.ones(late.sum(), np.int64)])
    best: dict[tuple, tuple] = {}  # of each shard of a hot anchor and phrase
    for n, v in enumerate(names):
        if v[2]:
            for k in range(len(v[3]) - size + 1):
                mark = (v[1], hashlib.blake2b(b" ".join(v[3][k : k + size]), digest_size=16).digest())
                here = (int(first["id"][n]), int(first["text"][n]), int(first["start"][n]) + k)
                best[mark] = min(best.get(mark, here), here)
    if best:
        marks = np.frombuffer(b"".join([m for _, m in best]), np.int64).reshape(-1, 2)
        where = np.array(list(best.values()), np.int64)
        more.append([marks[:, 0], marks[:, 1], where[:, 0], where[:, 1], where[:, 2], np.zeros(len(where), np.int64)])
    kinds = (np.int64, np.int64, np.int64, np.int64, np.int32, np.int32)
    none = np.zeros(0, np.int64)
    return pa.RecordBatch.from_arrays([pa.array(np.concatenate([none, *(m[c] for m in more)]).astype(kind)) for c, kind in enumerate(kinds)], names=["key", "more", "_id", "_hash", "start", "windows"])


def repeated_windows(rows: DataFrame, size: int = SIZE, k: int = ANCHOR, hot: int = HOT) -> DataFrame:
    """``_id, _hash, start, windows``: runs of windows that also start earlier."""
    passages = _passages(rows, _recurring_anchors(rows, size, k), size, k, hot)

    def shard(batches):
        held, last = [], None
        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if len(held) >= PASSAGES and row[:2] != last:
                    yield _located(held, size)
                    held = []
                held.append(row)
                last = row[:2]
        if held:
            yield _located(held, size)

    found = passages.repartition("anchor", "salt").sortWithinPartitions("anchor", "salt").mapInArrow(alone(shard), LOCATED)

    def earliest(batches):
        last, first = None, None
        for batch in batches:
            key, more, ids, texts, start, windows = (batch.column(c).to_numpy() for c in range(6))
            keep = windows > 0
            windows = windows.copy()
            for n in np.flatnonzero(~keep):  # sorted: the first of a phrase is its earliest place
                here = (ids[n], texts[n], start[n])
                if (key[n], more[n]) != last:
                    last, first = (key[n], more[n]), here
                elif here != first:
                    keep[n], windows[n] = True, 1
            yield pa.RecordBatch.from_arrays([pa.array(x[keep]) for x in (ids, texts, start, windows)], names=["_id", "_hash", "start", "windows"])

    spread = F.when(F.col("windows") > 0, F.xxhash64("_id", "_hash")).otherwise(F.col("key"))
    return found.repartition(spread).sortWithinPartitions("key", "more", "_id", "_hash", "start").mapInArrow(alone(earliest), "_id long, _hash long, start int, windows int")


def dedup(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", size: int = SIZE, hot: int = HOT) -> DataFrame:
    """All columns of the documents, and ``n_words, n_removed, kept`` (the kept words joined by one space)."""
    rows = _rows(docs, doc_id, text)
    spans = repeated_windows(rows, size, hot=hot).groupBy("_id", "_hash").agg(F.collect_list(F.struct("start", "windows")).alias("spans"))
    joined = rows.join(spans, ["_id", "_hash"], "left").select(*rows.columns, "spans")
    taken = joined.columns[: len(docs.columns)]
    schema = joined.select(*taken).schema.add("n_words", "long").add("n_removed", "long").add("kept", "string")

    def cut(batches):
        # a slice of texts at a time: neither this worker nor what it returns holds a whole batch once more
        for batch in (b.slice(i, j - i) for b in batches for i, j in slices(utf8(b.column("_text"))[1])):
            n_words, n_removed, kept = [], [], []
            for value, spans in zip(batch.column("_text"), batch.column("spans"), strict=True):
                words = value.as_buffer().to_pybytes().split() if value.is_valid else []
                gone = 0
                n_words.append(len(words))
                if spans.is_valid and len(spans):
                    own = spans.values
                    cover = np.zeros(len(words) + 1, np.int64)
                    start, count = own.field("start").to_numpy(), own.field("windows").to_numpy()
                    np.add.at(cover, start, 1)
                    np.add.at(cover, start + count + size - 1, -1)
                    stay = np.cumsum(cover[:-1]) == 0
                    gone = len(words) - int(stay.sum())
                    words = [words[n] for n in np.flatnonzero(stay)]
                n_removed.append(gone)
                kept.append(b" ".join(words))
            new = [pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64()), pa.array(kept, pa.binary()).cast(pa.string())]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in taken), *new], names=[*taken, "n_words", "n_removed", "kept"])

    out, own = joined.mapInArrow(alone(cut), schema), ("n_words", "n_removed", "kept")
    return out.select(*(F.col(t).alias(c) for t, c in zip(taken, docs.columns, strict=True) if c not in own), *own)
