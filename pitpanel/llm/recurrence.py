"""Which hashes of a corpus occur more than once: an exchange of packed entries.

A task gathers the documents it reads into *units* (at most ``UNIT`` hashes) and sends each unit's hashes, sorted and
packed, to bins by their leading bits.  A bin sees every occurrence of its hashes and answers each unit with its
entries that occur at least twice anywhere, and how often.  So the shuffle moves about 7 bytes a hash in few large
rows, no task holds more than one bin (a 1/bins share of the distinct hashes, however often one of them occurs, as a
unit sends a hash once for each owner) or one unit, and the answer holds only what recurs.

Units are numbered by input partition, so the input must be a stored table: a retried task then forms the same units.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession

from pitpanel.llm.text import forget

SCHEMA = "bin int, unit long, kind int, body binary"
HEADER, ENTRIES = 0, 1
UNIT = 1 << 20
MOST_OWNERS = 60_000
U64 = np.uint64


def bins_for(spark: SparkSession) -> int:
    """A power of two, some times the shuffle partitions."""
    return 1 << min(16, max(8, (4 * int(spark.conf.get("spark.sql.shuffle.partitions")) - 1).bit_length()))


class Packer:
    """Forms units; ``place`` adds a 32-bit number to each entry."""

    def __init__(self, bins: int, place: bool):
        self.bits, self.place, self.count = bins.bit_length() - 1, place, 0
        self.clear()

    def clear(self) -> None:
        self.hashes, self.places, self.sizes, self.headers, self.total = [], [], [], [], 0

    def add(self, header: bytes, hashes: np.ndarray, places: np.ndarray | None = None) -> Iterator[pa.RecordBatch]:
        """One owner; every header of a unit has the same length."""
        self.hashes.append(hashes)
        self.places.append(places)
        self.sizes.append(len(hashes))
        self.headers.append(header)
        self.total += len(hashes)
        if self.total >= UNIT or len(self.sizes) >= MOST_OWNERS:
            yield self.flush()

    def end(self) -> Iterator[pa.RecordBatch]:
        if self.sizes:
            yield self.flush()

    def flush(self) -> pa.RecordBatch:
        unit = (TaskContext.get().partitionId() << 32) + self.count
        self.count += 1
        hashes = np.concatenate(self.hashes)
        owner = np.repeat(np.arange(len(self.sizes), dtype=np.uint16), self.sizes)
        order = np.argsort(hashes, kind="stable")
        hashes, owner = hashes[order], owner[order]
        bins = (hashes >> U64(64 - self.bits)).astype(np.int64)
        rest = hashes << U64(self.bits)
        planes = [(rest >> U64(24)).astype(np.uint32), (rest >> U64(56)).astype(np.uint8), owner]
        if self.place:
            planes.append(np.concatenate(self.places)[order].astype(np.uint32))
        edges = np.flatnonzero(np.diff(bins, prepend=-1))
        ends = np.append(edges[1:], len(bins))
        bodies = [b"".join(p[a:b].tobytes() for p in planes) for a, b in zip(edges, ends, strict=True)]
        which = bins[edges].tolist()
        out = pa.RecordBatch.from_arrays([
            pa.array([unit % (1 << self.bits), *which], pa.int32()), pa.array([unit] * (1 + len(which)), pa.int64()),
            pa.array([HEADER] + [ENTRIES] * len(which), pa.int32()), pa.array([b"".join(self.headers), *bodies], pa.binary()),
        ], names=["bin", "unit", "kind", "body"])
        self.clear()
        return out


def _planes(body: bytes, kinds: tuple) -> list[np.ndarray]:
    n = len(body) // sum(np.dtype(k).itemsize for k in kinds)
    out, at = [], 0
    for k in kinds:
        out.append(np.frombuffer(body, k, n, at))
        at += n * np.dtype(k).itemsize
    return out


def recurring(packed: DataFrame, bins: int, place: bool, per_unit: Callable, schema: str) -> DataFrame:
    """Rows of ``per_unit(header, owner, hashes, counts, places) -> Iterator[RecordBatch]`` for each unit.

    header: the bytes of the unit's owners; of each entry whose hash occurs at least twice: its owner's index, the
    leading ``log2(bins) + 40`` bits of the hash, the occurrences in the corpus, and its place (or None).
    """
    bits = bins.bit_length() - 1
    sent = (np.uint32, np.uint8, np.uint16) + ((np.uint32,) if place else ())
    names = ["bin", "unit", "kind", "body"]

    def answer(group: pa.Table) -> pa.Table:
        forget()
        kinds, units, bodies = group["kind"].to_pylist(), group["unit"].to_pylist(), group["body"].to_pylist()
        out = [(units[i], HEADER, bodies[i]) for i, k in enumerate(kinds) if k == HEADER]
        parts = [(units[i], _planes(bodies[i], sent)) for i, k in enumerate(kinds) if k == ENTRIES]
        number = group["bin"][0].as_py()
        if parts:
            key = np.concatenate([p[1].astype(U64) << U64(32) | p[0] for _, p in parts])
            order = np.argsort(key, kind="stable")
            ranked = key[order]
            first = np.flatnonzero(np.concatenate([[True], ranked[1:] != ranked[:-1]]))
            runs = np.diff(np.append(first, len(ranked)))
            count = np.empty(len(key), np.uint32)
            count[order] = np.repeat(runs, runs)
            at = 0
            for unit, p in parts:
                own = count[at : at + len(p[0])]
                at += len(p[0])
                keep = own > 1
                if keep.any():
                    out.append((unit, ENTRIES, b"".join([*(x[keep].tobytes() for x in p), own[keep].tobytes()])))
        return pa.table([pa.array([number] * len(out), pa.int32()), pa.array([x[0] for x in out], pa.int64()), pa.array([x[1] for x in out], pa.int32()), pa.array([x[2] for x in out], pa.binary())], names=names)

    def gather(group: pa.Table) -> pa.Table:
        forget()
        kinds, numbers, bodies = group["kind"].to_pylist(), group["bin"].to_pylist(), group["body"].to_pylist()
        header = next(bodies[i] for i, k in enumerate(kinds) if k == HEADER)
        hashes, owners, counts, places = [], [], [], []
        for i, k in enumerate(kinds):
            if k == ENTRIES:
                low, high, owner, *more = _planes(bodies[i], (*sent, np.uint32))
                hashes.append((U64(numbers[i]) << U64(64 - bits)) | (high.astype(U64) << U64(56 - bits)) | (low.astype(U64) << U64(24 - bits)))
                owners.append(owner)
                counts.append(more[-1])
                places.append(more[0])
        join = lambda xs, kind: np.concatenate(xs) if xs else np.zeros(0, kind)
        return pa.Table.from_batches(list(per_unit(header, join(owners, np.uint16), join(hashes, U64), join(counts, np.uint32), join(places, np.uint32) if place else None)), schema=target)

    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    target = to_arrow_schema(StructType.fromDDL(schema))
    return packed.groupBy("bin").applyInArrow(answer, SCHEMA).groupBy("unit").applyInArrow(gather, schema)
