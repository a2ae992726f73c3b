"""Tokenised documents in binary files: one concatenated id array, document boundaries in Elias-Fano form.

A file holds, in ascending document order: ids (little-endian, ``width`` bytes each), the documents' own ids (64-bit),
and the end offsets of the documents as an Elias-Fano sequence: about ``2 + log2(mean length)`` bits a document.  Its
select structure (the place of every 256th high bit) answers the i-th offset, or those of a run of documents, from the
bytes near its marks; no table of 64-bit offsets exists, neither in the file nor while it is read.  A JSON footer tells the places of the parts.

Files are written by one range-partitioned, sorted pass, each under a name of its task attempt; the manifest lists what
successful attempts wrote, so retried or lost tasks leave at most unlisted files.

Texts are cut where a letter or ASCII sign is followed by ASCII white space, which the byte-level pre-tokenizer never
joins; each distinct piece goes through the tokenizers library once per worker (bounded cache).  Added tokens in a text
(such as ``<|endoftext|>``) become their own id, as in the library's ``encode``.

Defined cases: null and empty texts have only the end id; a null id sorts first and is read back as null; equal ids are
ordered by their text's hash; an empty table makes no file; extra columns are ignored.
"""

from __future__ import annotations

import json
import zlib
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pitpanel.llm.text import SLICE, U64, _BYTES, _powers, file_system, fresh_folder, mix, slices, stored, utf8

MAGIC = b"EFIDS01\n"
NO_ID = -(1 << 63)
STEP = 256
#: Bytes of new pieces that go through the library as one text.
GROUP = 20_000
#: Distinct pieces that a worker remembers.
CACHE = 1 << 20


class EliasFano:
    """A non-decreasing sequence of n numbers, the last of which is its largest."""

    def __init__(self, n: int, low_bits: int, low: np.ndarray, high: np.ndarray, marks: np.ndarray):
        self.n, self.low_bits, self.low, self.high, self.marks = n, low_bits, low, high, marks

    @classmethod
    def of(cls, values: np.ndarray) -> EliasFano:
        values, n = values.astype(np.int64), len(values)
        bits = max(0, (int(values[-1]) // n).bit_length() - 1) if n else 0
        low = ((values[:, None] >> np.arange(bits - 1, -1, -1)) & 1).astype(np.uint8) if bits else np.zeros((n, 0), np.uint8)
        ones = (values >> bits) + np.arange(n)
        high = np.zeros(int(ones[-1]) + 1 if n else 0, np.uint8)
        high[ones] = 1
        return cls(n, bits, np.packbits(low.ravel()), np.packbits(high), ones[::STEP].astype(np.uint32))

    def _low(self, a: int, b: int) -> np.ndarray:
        if not self.low_bits:
            return np.zeros(b - a, np.int64)
        first = a * self.low_bits
        got = np.unpackbits(self.low[first // 8 : -(-b * self.low_bits // 8)])[first % 8 : first % 8 + (b - a) * self.low_bits]
        return got.reshape(b - a, self.low_bits) @ (1 << np.arange(self.low_bits - 1, -1, -1))

    def select(self, i: int) -> int:
        """The i-th number."""
        start = int(self.marks[i // STEP])
        rest = i % STEP
        at, byte = start, start // 8
        count = -1
        while True:  # forward from the last marked bit
            ones = np.flatnonzero(np.unpackbits(self.high[byte : byte + 64])) + 8 * byte
            ones = ones[ones >= at]
            if count + len(ones) >= rest:
                high = int(ones[rest - count - 1])
                break
            count += len(ones)
            byte += 64
        return (high - i << self.low_bits) | int(self._low(i, i + 1)[0])

    def between(self, a: int, b: int) -> np.ndarray:
        """Numbers a to b - 1: the bits from the last mark before a to the first after b, and no others."""
        if a >= b:
            return np.zeros(0, np.int64)
        mark, after = a // STEP, -(-b // STEP)
        byte = int(self.marks[mark]) // 8
        end = int(self.marks[after]) // 8 + 1 if after < len(self.marks) else len(self.high)
        ones = np.flatnonzero(np.unpackbits(self.high[byte:end])) + 8 * byte
        ones = ones[np.searchsorted(ones, self.marks[mark]) + a - STEP * mark :][: b - a]
        return ((ones - np.arange(a, b)) << self.low_bits) | self._low(a, b)

    def all(self) -> np.ndarray:
        ones = np.flatnonzero(np.unpackbits(self.high))[: self.n]
        return ((ones - np.arange(self.n)) << self.low_bits) | self._low(0, self.n)

    def parts(self) -> list[tuple[str, np.ndarray]]:
        return [("low", self.low), ("high", self.high), ("marks", self.marks)]


class Encoder:
    """Ids of whole texts, through the library once for each distinct piece."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        added = self.tokenizer.get_added_tokens_decoder()
        if any(t.lstrip or t.rstrip or t.single_word or not _WHITE.isdisjoint(t.content.encode()) for t in added.values()):
            raise ValueError("cuts at white space could part an added token from what it takes in")
        self.added = [t.content.encode() for t in added.values()]
        size = self.tokenizer.get_vocab_size()
        self.bytes_of = np.array([len(self.tokenizer.id_to_token(k) or "") for k in range(size)])  # one letter a byte
        for k, t in added.items():
            self.bytes_of[k] = len(t.content.encode())  # stands for itself
        self.clear()

    def clear(self) -> None:
        self.place: dict[int, int] = {}
        self.flat, self.used = np.zeros(1 << 16, np.uint32), 0
        self.start, self.size = np.zeros(1 << 12, np.int64), np.zeros(1 << 12, np.int64)

    def _learn(self, keys: list[int], data: np.ndarray, begin: np.ndarray, end: np.ndarray) -> None:
        """Keeps the ids of the pieces data[begin:end]; those that begin and end as cuts do go through the library joined."""
        sizes = end - begin
        # a piece between cuts begins with white space and ends in a letter or sign; added tokens hold no white space
        last = data[end - 1]
        joins = _WHITE_TABLE[data[begin]] & (((last > 0x20) & (last < 0x7F)) | ((sizes > 1) & (data[end - 2] == 0xC3)))
        raw = data.tobytes()
        if any(t in raw for t in self.added):
            joins &= np.array([not any(t in raw[a:b] for t in self.added) for a, b in zip(begin.tolist(), end.tolist(), strict=True)])
        plain = np.flatnonzero(joins)
        ends = np.cumsum(sizes[plain])
        joined = data[np.arange(ends[-1]) + np.repeat(begin[plain] - (ends - sizes[plain]), sizes[plain])].tobytes() if len(plain) else b""
        edges = [0, *(np.flatnonzero(np.diff((ends - 1) // GROUP)) + 1).tolist(), len(plain)]
        groups = [(plain[i:j], joined[ends[i] - sizes[plain[i]] : ends[j - 1]]) for i, j in zip(edges[:-1], edges[1:], strict=True) if j > i]
        groups += [(np.array([k]), raw[begin[k] : end[k]]) for k in np.flatnonzero(~joins).tolist()]
        for i in range(0, len(groups), 64):
            some = groups[i : i + 64]
            got = self.tokenizer.encode_batch_fast([text.decode() for _, text in some], add_special_tokens=False)
            for (own, _), e in zip(some, got, strict=True):
                ids = np.array(e.ids, np.uint32)
                cuts = np.searchsorted(np.cumsum(self.bytes_of[ids]), np.cumsum(sizes[own])) + 1 if len(own) > 1 else np.array([len(ids)])
                self._keep([keys[k] for k in own.tolist()], ids, cuts)

    def _keep(self, keys: list[int], ids: np.ndarray, cuts: np.ndarray) -> None:
        while self.used + len(ids) > len(self.flat):
            self.flat = np.concatenate([self.flat, np.zeros_like(self.flat)])
        first = len(self.place)
        while first + len(keys) > len(self.start):
            self.start, self.size = (np.concatenate([x, np.zeros_like(x)]) for x in (self.start, self.size))
        self.flat[self.used : self.used + len(ids)] = ids
        begin = np.concatenate([[0], cuts[:-1]])
        self.start[first : first + len(keys)] = self.used + begin
        self.size[first : first + len(keys)] = cuts - begin
        self.place.update(zip(keys, range(first, first + len(keys)), strict=True))
        self.used += len(ids)

    def encode(self, data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the texts one after the other, and the number of ids of each."""
        if not len(data):
            return np.zeros(0, np.uint32), np.zeros(len(offs) - 1, np.int64)
        white = _WHITE_TABLE[data]
        sure = (data > 0x20) & (data < 0x7F)
        sure[1:] |= data[:-1] == 0xC3
        cut = np.zeros(len(data), bool)
        cut[1:] = white[1:] & sure[:-1]
        cut[offs[:-1][np.diff(offs) > 0]] = True
        starts = np.flatnonzero(cut)
        ends = np.append(starts[1:], len(data))
        power, inverse = _powers(len(data) + 1)
        total = np.zeros(len(data) + 1, U64)
        np.cumsum(_BYTES[data] * power[: len(data)], out=total[1:])
        keys = mix((total[ends] - total[starts]) * inverse[starts] + (ends - starts).astype(U64))
        distinct, first, which = np.unique(keys, return_index=True, return_inverse=True)
        if len(self.place) + len(distinct) > CACHE:
            self.clear()
        wanted = distinct.tolist()
        slots = np.fromiter(map(self.place.get, wanted, repeat(-1)), np.int64, len(wanted))
        fresh = np.flatnonzero(slots < 0)
        if len(fresh):
            at, unknown = first[fresh], [wanted[k] for k in fresh.tolist()]
            self._learn(unknown, data, starts[at], ends[at])
            slots[fresh] = np.fromiter(map(self.place.__getitem__, unknown), np.int64, len(unknown))
        slot = slots[which]
        size = self.size[slot]
        after = np.cumsum(size)
        ids = self.flat[np.arange(after[-1]) + np.repeat(self.start[slot] - (after - size), size)]
        before = np.concatenate([[0], after])[np.searchsorted(starts, offs)]  # ids before each text
        return ids, np.diff(before)


_WHITE = frozenset([0x20, *range(0x09, 0x0E)])
_WHITE_TABLE = np.isin(np.arange(256), list(_WHITE))
_ENCODERS: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """The worker's encoder of a tokenizer file, kept from task to task."""
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]


def write(docs: DataFrame, folder: str, tokenizer: str, *, doc_id: str = "doc_id", text: str = "text", end_id: int | None = 0, width: int = 2, partitions: int | None = None) -> DataFrame:
    """Writes the files into ``folder`` and returns the manifest, stored: ``part, path, n_docs, n_ids, start`` in order.

    start: ids before the file.  One file for each partition of documents (``partitions``, or the shuffle partitions).
    """
    spark = docs.sparkSession
    rows = docs.select(F.coalesce(F.col(doc_id).cast("long"), F.lit(NO_ID)).alias("id"), F.col(text).alias("text"))
    n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    kind = np.dtype(f"<u{width}")

    def run(batches):
        task = TaskContext.get()
        name = f"part-{task.partitionId():06d}-{task.taskAttemptId()}.ids"
        system, place = file_system(f"{folder}/{name}")
        system.create_dir(place.rpartition("/")[0], recursive=True)
        out, own, lengths, last = None, [], [], np.array([end_id] if end_id is not None else [], kind)
        for batch in batches:
            if not batch.num_rows:
                continue
            if out is None:
                out = system.open_output_stream(place)
                out.write(MAGIC)
            own.append(batch.column("id").to_numpy())
            data, offs = utf8(batch.column("text"))
            for i, j in slices(offs, SLICE):
                ids, counts = encoder(tokenizer).encode(data[offs[i] : offs[j]], offs[i : j + 1] - offs[i])
                if len(ids) and int(ids.max()) > np.iinfo(kind).max:
                    raise ValueError(f"ids need more than {width} bytes")
                if len(last):
                    ids = np.insert(ids, np.cumsum(counts), last[0])
                lengths.append(counts + len(last))
                out.write(ids.astype(kind).tobytes())
        if out is None:
            return
        ends = np.cumsum(np.concatenate(lengths))
        n_ids = int(ends[-1])
        boundaries = EliasFano.of(ends)
        about = {"n_docs": len(ends), "n_ids": n_ids, "width": width, "low_bits": boundaries.low_bits, "at": {}}
        at = len(MAGIC) + n_ids * width
        for part, values in [("doc_ids", np.concatenate(own).astype("<i8")), *boundaries.parts()]:
            raw = values.tobytes()
            about["at"][part] = [at, len(raw)]
            out.write(raw)
            at += len(raw)
        footer = json.dumps(about).encode()
        out.write(footer + len(footer).to_bytes(8, "little") + MAGIC)
        out.close()
        yield pa.RecordBatch.from_arrays([pa.array([task.partitionId()], pa.int32()), pa.array([name]), pa.array([len(ends)], pa.int64()), pa.array([n_ids], pa.int64())], names=["part", "name", "n_docs", "n_ids"])

    order = [F.col("id"), F.xxhash64("text")]
    files = stored(rows.repartitionByRange(n, *order).sortWithinPartitions(*order).mapInArrow(run, "part int, name string, n_docs long, n_ids long"), "manifest")
    listed, start = [], 0
    for f in sorted(files.collect()):  # one row a file
        listed.append((f.part, f"{folder}/{f.name}", f.n_docs, f.n_ids, start))
        start += f.n_ids
    return spark.createDataFrame(listed, "part int, path string, n_docs long, n_ids long, start long")


class TokenFile:
    """Random access to a written file: document i is ``ids(i)``."""

    def __init__(self, path: str):
        system, place = file_system(path)
        self.file = system.open_input_file(place)
        size = self.file.size()
        tail = self.file.read_at(16, size - 16)
        if tail[8:] != MAGIC:
            raise ValueError(f"not a token file: {path}")
        length = int.from_bytes(tail[:8], "little")
        about = json.loads(self.file.read_at(length, size - 16 - length))
        self.n_docs, self.n_ids, self.kind = about["n_docs"], about["n_ids"], np.dtype(f"<u{about['width']}")
        part = lambda name, kind: np.frombuffer(self.file.read_at(about["at"][name][1], about["at"][name][0]), kind)
        self.doc_ids = part("doc_ids", "<i8")
        self.ends = EliasFano(self.n_docs, about["low_bits"], part("low", np.uint8), part("high", np.uint8), part("marks", np.uint32))

    def range(self, a: int, b: int) -> np.ndarray:
        w = self.kind.itemsize
        return np.frombuffer(self.file.read_at((b - a) * w, len(MAGIC) + a * w), self.kind)

    def ids(self, i: int) -> np.ndarray:
        return self.range(self.ends.select(i - 1) if i else 0, self.ends.select(i))


def read(spark: SparkSession, manifest: DataFrame) -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32`` of every document, from the files of a manifest."""

    def run(batches):
        for batch in batches:
            for path, base in zip(batch.column("path").to_pylist(), batch.column("start").to_pylist(), strict=True):
                file = TokenFile(path)
                for i in range(0, file.n_docs, 4096):
                    own = file.ends.between(i, min(i + 4096, file.n_docs))
                    first = file.ends.select(i - 1) if i else 0
                    sums, begin = [], np.concatenate([[first], own[:-1]])
                    for a, b in _blocks(begin, own):
                        ids = file.range(int(begin[a]), int(own[b - 1])).astype("<u4")
                        sums += [zlib.crc32(ids[x - begin[a] : y - begin[a]]) for x, y in zip(begin[a:b].tolist(), own[a:b].tolist(), strict=True)]
                    own_ids = file.doc_ids[i : i + 4096]
                    yield pa.RecordBatch.from_arrays([pa.array(own_ids, mask=own_ids == NO_ID), pa.array(base + begin), pa.array(own - begin), pa.array(sums, pa.int64())], names=["doc_id", "start", "n_tokens", "ids_crc32"])

    files = manifest.select("path", "start")
    return files.repartition(max(1, manifest.count()), "path").mapInArrow(run, "doc_id long, start long, n_tokens long, ids_crc32 long")


def _blocks(begin: np.ndarray, end: np.ndarray, most: int = 1 << 20):
    """Ranges of documents with at most ``most`` ids, or one document."""
    i = 0
    while i < len(end):
        j = max(i + 1, int(np.searchsorted(end, begin[i] + most, "right")))
        yield i, j
        i = j


def round_trip(docs: DataFrame, tokenizer: str, **options) -> DataFrame:
    """Writes the files into a fresh folder under ``spark.checkpoint.dir`` and reads them back."""
    spark = docs.sparkSession
    return read(spark, write(docs, fresh_folder(spark, "token-files"), tokenizer, **options))
