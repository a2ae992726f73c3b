"""SentencePiece encoding, decoding and sampled segmentations without replacement.

A text's segmentations into the vocabulary's pieces form a lattice; one has the probability proportional to the product
of its pieces' weights, ``(2 + rank) ** -alpha`` by merge rank (byte fallback: the last rank for each byte).  The k
segmentations with the largest Gumbel-perturbed log-probabilities are found best first (A*): a region of the lattice has
as its key the largest perturbed value in it, drawn from its exact mass; the best region yields its segmentation, and
what is left of it is split into disjoint regions by the first place that differs.  So the samples are distinct, in
order of their keys, and the (k+1)-th key gives each sample's inclusion score ``1 - exp(-exp(log_prob - key))``.
Noise comes from a generator seeded by the row's key, so a retried task repeats its samples.

Texts are cut where no piece can cross (no piece has the two letters side by side); the lattice then is the product of
its parts' lattices.  Of each distinct part a worker keeps (bounded, in flat arrays) its total mass and its ``BEST``
likeliest segmentations; others are drawn by backward sampling when the draw falls outside these.  Parts not met before
are learnt together, whatever their lengths: all their lattices advance by one letter at a time.

Defined cases: null and empty texts have one empty segmentation, of probability 1 and inclusion 1; a text with fewer
than k segmentations yields all of them, with inclusion 1; the letter U+2581 reads as a space; repeated rows have equal
samples; an empty table gives no rows; other columns are kept if named.
"""

from __future__ import annotations

import math
import zlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pitpanel.llm.text import SLICE, U64, _powers, mix, slices, worker_cache

SPACE = "▁"
BEST = 6
LONGEST = 16
#: Segmentations beyond the best ones that together have a smaller share of a part count as none.
TINY = 1e-9
#: Distinct parts a worker keeps, and lattices of parts for backward sampling.
CACHE = 500_000
LATTICES = 1_000
#: Letters of parts whose lattices are computed together, and parts of texts that are sampled together.
TOGETHER = 100_000
SAMPLES = 2
SEED = 0


def _ragged(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Indexes of the runs start .. start + size, one after the other."""
    ends = np.cumsum(sizes)
    return np.arange(int(ends[-1]) if len(ends) else 0) + np.repeat(starts - (ends - sizes), sizes)


def _utf8_sizes(codes: np.ndarray) -> np.ndarray:
    return np.where(codes < 0x80, 1, np.where(codes < 0x800, 2, np.where(codes < 0x10000, 3, 4)))


class Vocabulary:
    """Pieces of a model file, where texts can be cut, and what is known of the parts met so far."""

    def __init__(self, path: str, alpha: float):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        n = self.model.get_piece_size()
        plain = [k for k in range(n) if not (self.model.is_byte(k) or self.model.is_control(k) or self.model.is_unknown(k) or self.model.is_unused(k))]
        self.pieces = {self.model.id_to_piece(k): k for k in plain}
        self.names = [self.model.id_to_piece(k) for k in range(n)]
        self.byte_ids = {int(self.names[k][3:5], 16): k for k in range(n) if self.model.is_byte(k)}
        alone = {v: k for k, v in self.byte_ids.items()}
        self.raw = [bytes([alone[k]]) if k in alone else p.replace(SPACE, " ").encode() for k, p in enumerate(self.names)]
        self.is_byte = [k in alone for k in range(n)]
        rank = np.full(n, n, float)
        scores = np.array([self.model.get_score(k) for k in plain])
        rank[np.array(plain)[np.argsort(-scores, kind="stable")]] = np.arange(len(plain))
        self.weight = -alpha * np.log(2 + rank)
        self.byte_weight = -alpha * float(np.log(2 + n))
        letters = sorted({c for p in self.pieces for c in p})
        self.letter = np.zeros(0x10000, np.int64)
        for k, c in enumerate(letters):
            if ord(c) < 0x10000:
                self.letter[ord(c)] = k + 1
        self.wide = len(letters) + 1
        self.beside = np.zeros(self.wide * self.wide, bool)
        for p in self.pieces:
            at = self.letter[[min(ord(c), 0xFFFF) for c in p]]
            self.beside[at[:-1] * self.wide + at[1:]] = True
        self.beside[: self.wide] = False
        keys = self._keys([p for p in self.pieces])
        order = np.argsort(keys)
        self.keys, self.ids = keys[order], np.array(list(self.pieces.values()))[order]
        prefix = (self.keys >> U64(44)).astype(np.int64)
        self.bucket = np.full(1 << 20, -1, np.int32)  # the first piece of a hash prefix: a quick no for most substrings
        self.bucket[prefix[::-1]] = np.arange(len(prefix), dtype=np.int32)[::-1]
        self.crowd = int(np.bincount(np.unique(prefix, return_inverse=True)[1]).max())
        sizes = np.array([len(x) for x in self.raw])
        self.raw_flat, self.raw_first, self.raw_size = np.frombuffer(b"".join(self.raw), np.uint8), np.cumsum(sizes) - sizes, sizes
        self.of_byte = np.array([self.byte_ids[b] for b in range(256)])
        self.clear()

    def clear(self) -> None:
        self.lattices: dict[int, tuple] = {}
        self.rows = 0
        self.known, self.row_of = np.zeros(0, U64), np.zeros(0, np.int32)  # hashes of the parts, sorted, and their rows
        self.slot = np.full(1 << 20, -1, np.int32)  # the row met last for a hash prefix
        size = 1 << 12
        self.key = np.zeros(size, U64)
        self.logs = np.zeros((size, BEST))  # log-probabilities of the best segmentations
        self.up_to = np.zeros((size, BEST))  # shares of these, added up
        self.rest = np.zeros((size, BEST))  # logarithms of what is left without each of these
        self.other = np.zeros(size)  # share of all others
        self.exact = np.zeros(size, bool)  # the library's encoding decodes to the part
        self.start, self.size = np.zeros((size, BEST + 1), np.int32), np.zeros((size, BEST + 1), np.int32)
        self.flat, self.used = np.zeros(1 << 16, np.uint16 if len(self.names) <= 1 << 16 else np.int32), 0

    @staticmethod
    def _keys(parts: list[str]) -> np.ndarray:
        codes = np.frombuffer("".join(parts).encode("utf-32-le", "surrogatepass"), np.uint32)
        size = np.array([len(p) for p in parts])
        ends = np.cumsum(size)
        return Vocabulary._hash(codes, ends - size, ends)

    @staticmethod
    def _hash(codes: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        power, inverse = _powers(len(codes) + 1)
        total = np.zeros(len(codes) + 1, U64)
        np.cumsum(mix(codes.astype(U64) + U64(1)) * power[: len(codes)], out=total[1:])
        return mix((total[ends] - total[starts]) * inverse[starts] + (ends - starts).astype(U64))

    def cut(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The known-part number of every part of the texts, and the parts of each text."""
        joined = "".join([SPACE + t if t else "" for t in texts]).replace(" ", SPACE)
        codes = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)
        if not len(codes):
            return np.zeros(0, np.int64), np.zeros(len(texts), np.int64)
        letter = self.letter[np.where(codes < 0x10000, codes, 0)]
        begin = np.ones(len(codes), bool)
        begin[1:] = ~self.beside[letter[:-1] * self.wide + letter[1:]]
        size = np.array([len(t) + 1 if t else 0 for t in texts])
        first = np.cumsum(size) - size
        begin[first[size > 0]] = True
        starts = np.flatnonzero(begin)
        ends = np.append(starts[1:], len(codes))
        per_text = np.diff(np.searchsorted(starts, np.append(first, len(codes))))
        return self._numbers(codes, starts, ends), per_text

    def _numbers(self, codes: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """The rows of parts, which are learnt if they are new."""
        keys = self._hash(codes, starts, ends)
        slot = (keys >> U64(44)).astype(np.int64)
        row = self.slot[slot].astype(np.int64)
        missed = np.flatnonzero((row < 0) | (self.key[row] != keys))
        if not len(missed):
            return row
        distinct, at, which = np.unique(keys[missed], return_index=True, return_inverse=True)
        place = np.searchsorted(self.known, distinct)
        fresh = np.ones(len(distinct), bool)
        inside = np.flatnonzero(place < len(self.known))
        fresh[inside] = self.known[place[inside]] != distinct[inside]
        if self.rows and self.rows + int(fresh.sum()) > CACHE:
            self.clear()
            return self._numbers(codes, starts, ends)
        found = np.zeros(len(distinct), np.int64)
        found[~fresh] = self.row_of[place[~fresh]]
        if fresh.any():
            first = missed[at[fresh]]
            found[fresh] = self.learn(distinct[fresh], codes, starts[first], ends[first] - starts[first])
            self.known = np.insert(self.known, place[fresh], distinct[fresh])
            self.row_of = np.insert(self.row_of, place[fresh], found[fresh])
        row[missed] = found[which]
        self.slot[slot[missed]] = row[missed]
        return row

    # -- lattices of parts

    @staticmethod
    def _longer(old: np.ndarray, least: int) -> np.ndarray:
        """The same rows with room for more; the room is not touched, so it takes no memory yet."""
        size = len(old)
        while size < least:
            size *= 2
        if size == len(old):
            return old
        new = np.zeros((size, *old.shape[1:]), old.dtype)
        new[: len(old)] = old
        return new

    def learn(self, keys: np.ndarray, codes: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """Rows of new parts: runs of letters of codes."""
        order = np.argsort(-sizes, kind="stable")
        rows = np.empty(len(keys), np.int64)
        rows[order] = self.rows + np.arange(len(keys))
        starts, sizes, first = starts[order], sizes[order], self.rows
        self.rows += len(keys)
        for name in ("key", "logs", "up_to", "rest", "other", "exact", "start", "size"):
            setattr(self, name, self._longer(getattr(self, name), self.rows))
        self.key[rows] = keys
        ends = np.cumsum(sizes)
        i = 0
        while i < len(sizes):
            j = max(i + 1, int(np.searchsorted(ends, ends[i] - sizes[i] + TOGETHER, "right")))
            row, some = np.arange(first + i, first + j), codes[_ragged(starts[i:j], sizes[i:j])]
            self._lattice(row, some, sizes[i:j])
            self._encode(row, some, sizes[i:j])
            i = j
        return rows

    def _keep(self, row: np.ndarray, slot: int | slice, sizes: np.ndarray, ids: np.ndarray) -> None:
        self.flat = self._longer(self.flat, self.used + len(ids))
        self.flat[self.used : self.used + len(ids)] = ids
        self.start[row, slot] = (self.used + np.cumsum(sizes) - sizes.ravel()).reshape(sizes.shape)
        self.size[row, slot] = sizes
        self.used += len(ids)

    def _encode(self, row: np.ndarray, codes: np.ndarray, size: np.ndarray) -> None:
        """The library's own encoding; parts between line ends, which no piece joins."""
        line = self.byte_ids[10]
        first = np.cumsum(size) - size
        ends_line = (size == 1) & (codes[first] == 10)  # that part is a line end itself
        if ends_line.any():
            self._keep(row[ends_line], BEST, np.ones(int(ends_line.sum()), np.int64), np.full(int(ends_line.sum()), line))
            self.exact[row[ends_line]] = True
            codes, row, size = codes[np.repeat(~ends_line, size)], row[~ends_line], size[~ends_line]
            first = np.cumsum(size) - size
        codes = np.where(codes == ord(SPACE), 32, codes).astype(np.uint32)
        for i in range(0, len(size), 2000):
            some = size[i : i + 2000]
            own = codes[first[i] : first[i] + int(some.sum())]
            lines = np.full(len(own) + len(some) + 1, 10, np.uint32)
            lines[np.arange(len(own)) + np.repeat(np.arange(1, len(some) + 1), some)] = own
            ids = np.array(self.model.encode(lines.tobytes().decode("utf-32-le", "surrogatepass")), np.int64)
            at = np.flatnonzero(ids == line)
            sizes, ids = np.diff(at) - 1, ids[at[0] :]
            ids = ids[ids != line]
            self._keep(row[i : i + 2000], BEST, sizes, ids)
            self.exact[row[i : i + 2000]] = self._decodes(ids, sizes, own, some)

    def _decodes(self, ids: np.ndarray, sizes: np.ndarray, codes: np.ndarray, letters: np.ndarray) -> np.ndarray:
        """Which of some id sequences decode to their parts."""
        made = self.raw_flat[_ragged(self.raw_first[ids], self.raw_size[ids])]
        want = np.frombuffer(codes.tobytes().decode("utf-32-le", "surrogatepass").encode("utf-8", "surrogatepass"), np.uint8)
        have = np.diff(np.concatenate([[0], np.cumsum(self.raw_size[ids])])[np.concatenate([[0], np.cumsum(sizes)])])
        need = np.diff(np.concatenate([[0], np.cumsum(_utf8_sizes(codes))])[np.concatenate([[0], np.cumsum(letters)])])
        good = np.ones(len(sizes), bool)
        if np.array_equal(have, need):
            good[np.searchsorted(np.cumsum(need), np.flatnonzero(made != want), "right")] = False
        else:
            good[:] = False
        stop, end = np.cumsum(sizes), np.cumsum(letters)
        for k in np.flatnonzero(~good):
            good[k] = self._text(ids[stop[k] - sizes[k] : stop[k]].tolist()) == codes[end[k] - letters[k] : end[k]].tobytes().decode("utf-32-le", "surrogatepass")
        return good

    def _lattice(self, row: np.ndarray, codes: np.ndarray, size: np.ndarray) -> None:
        """Forward over parts, the longest first, side by side: masses and the BEST best segmentations.

        A part of n letters has n + 1 places; an edge is a piece, from the place before it to the one after its last letter.
        """
        n, many, reach = len(size), len(codes), min(int(size[0]), LONGEST)
        first = np.cumsum(size) - size
        part = np.repeat(np.arange(n), size)
        place = np.arange(many) - first[part]
        power, inverse = _powers(many + 1)
        total = np.zeros(many + 1, U64)
        np.cumsum(mix(codes.astype(U64) + U64(1)) * power[:many], out=total[1:])
        found = np.full((many, reach), -2, np.int32)  # the piece of k + 1 letters that ends with a letter; -1: the letter's bytes
        found[:, 0] = -1
        for k in range(reach):
            end = np.flatnonzero(place >= k) if k else np.arange(many)
            key = mix((total[end + 1] - total[end - k]) * inverse[end - k] + U64(k + 1))
            spot = self.bucket[(key >> U64(44)).astype(np.int64)]
            likely = np.flatnonzero(spot >= 0)
            end, key, spot = end[likely], key[likely], spot[likely]
            for step in range(self.crowd):
                at = np.minimum(spot + step, len(self.keys) - 1)
                same = self.keys[at] == key
                found[end[same], k] = self.ids[at[same]]
        edge = np.flatnonzero(found.ravel() > -2)
        letter, k = edge // reach, edge % reach
        piece = found.ravel()[edge]
        bytes_of = _utf8_sizes(codes)
        weight = np.where(piece < 0, bytes_of[letter] * self.byte_weight, self.weight[piece])
        source = letter + part[letter] - k
        ways = np.bincount(letter, minlength=many)
        ahead = np.cumsum(ways) - ways
        after = np.arange(many) + part + 1
        mass = np.zeros(many + n)
        score = np.full((many + n, BEST), -np.inf)
        score[first + np.arange(n), 0] = 0
        back = np.zeros((many + n, BEST), np.uint8)
        level = place * (LONGEST + 1) + ways  # letters of one place and number of edges go together
        order = np.argsort(level.astype(np.uint16) if int(size[0]) * (LONGEST + 1) < 1 << 16 else level, kind="stable")
        cuts = np.concatenate([[0], np.flatnonzero(np.diff(level[order])) + 1, [many]]).tolist()
        for a, b in zip(cuts[:-1], cuts[1:], strict=True):
            at = order[a:b]
            node, d = after[at], int(ways[at[0]])
            if d == 1:
                e = ahead[at]
                score[node] = score[source[e]] + weight[e][:, None]
                back[node] = np.arange(BEST)
                mass[node] = mass[source[e]] + weight[e]
                continue
            e = ahead[at] + np.arange(d)[:, None]
            origin, gain = source[e], weight[e]
            masses = mass[origin] + gain
            most = masses.max(axis=0)
            mass[node] = most + np.log(np.exp(masses - most).sum(axis=0))
            options = (score[origin.T] + gain.T[:, :, None]).reshape(b - a, -1)
            top = np.argsort(-options, axis=1, kind="stable")[:, :BEST]
            score[node] = options[np.arange(b - a)[:, None], top]
            back[node] = top
        last = first + size + np.arange(n)
        logs = score[last] - mass[last][:, None]
        share = np.exp(logs)
        other = 1 - share.sum(axis=1)
        other = np.where(np.isneginf(score[last, BEST - 1]) | (other < TINY), 0, other)
        up_to = np.cumsum(share, axis=1)
        # without others, the last segmentation there is takes the rounding
        up_to[np.arange(BEST) >= np.where(other == 0, np.maximum(1, (share > 0).sum(axis=1)) - 1, BEST)[:, None]] = np.inf
        self.logs[row], self.up_to[row], self.other[row] = logs, up_to, other
        with np.errstate(divide="ignore"):
            for s in range(BEST):
                self.rest[row, s] = np.log(np.delete(share, s, axis=1).sum(axis=1) + other)
        path = np.flatnonzero(~np.isneginf(score[last]).ravel())
        own, state = path // BEST, path % BEST
        node, steps = last[own], []
        while len(path):
            code = back[node, state]
            e = ahead[node - own - 1] + code // BEST
            steps.append((path, e))
            node, state = source[e], code % BEST
            go = np.flatnonzero(node > first[own] + own)
            path, own, node, state = path[go], own[go], node[go], state[go]
        width = np.where(piece < 0, bytes_of[letter], 1)
        sizes = np.zeros(n * BEST, np.int64)
        for path, e in steps:
            sizes[path] += width[e]
        tail = np.cumsum(sizes)
        ids = np.zeros(int(tail[-1]), np.int64)
        if (piece < 0).any():
            raw = np.frombuffer(codes.tobytes().decode("utf-32-le", "surrogatepass").encode(), np.uint8)
            begin = np.cumsum(bytes_of) - bytes_of
        for path, e in steps:
            tail[path] -= width[e]
            ids[tail[path]] = piece[e]
            lone = np.flatnonzero(piece[e] < 0)  # a letter without a piece is its bytes
            if len(lone):
                wide = width[e[lone]]
                ids[_ragged(tail[path[lone]], wide)] = self.of_byte[raw[_ragged(begin[letter[e[lone]]], wide)]]
        self._keep(row, slice(0, BEST), sizes.reshape(n, BEST), ids)

    def _edges(self, part: int) -> tuple[list[float], list[list]]:
        """Of a part: the log-mass up to each place, and the pieces that end there (start, ids, log-weight)."""
        if part in self.lattices:
            return self.lattices[part]
        text = self._text(self.best(part, 0)).replace(" ", SPACE)
        mass, edges = [0.0], [[]]
        for j in range(1, len(text) + 1):
            own = []
            for i in range(max(0, j - LONGEST), j):
                k = self.pieces.get(text[i:j])
                if k is not None:
                    own.append((i, (k,), float(self.weight[k])))
                elif i == j - 1:
                    raw = text[i:j].encode()
                    own.append((i, tuple(self.byte_ids[b] for b in raw), len(raw) * self.byte_weight))
            edges.append(own)
            logs = [mass[i] + w for i, _, w in own]
            top = max(logs)
            mass.append(top + math.log(sum(math.exp(x - top) for x in logs)))
        if len(self.lattices) >= LATTICES:
            self.lattices.clear()
        self.lattices[part] = mass, edges
        return mass, edges

    def draw(self, part: int, random: np.random.Generator, without: set) -> tuple[tuple[int, ...], float]:
        """A segmentation of a part by its probability among those not excluded: ids and log-probability.

        Sampled from the end; each piece is weighed by the mass before it less what of that mass is excluded.
        """
        mass, edges = self._edges(part)
        gone = [(w, [self.byte_weight if self.is_byte[k] else float(self.weight[k]) for k in w]) for w in without]
        at, out, log = len(mass) - 1, [], 0.0
        while at:
            weights, kept = [], []
            for i, ids, w in edges[at]:
                n = len(ids)
                same = [(x[:-n], y[:-n]) for x, y in gone if x[-n:] == ids]
                rest = math.exp(mass[i] + w - mass[at]) - sum(math.exp(sum(y) + w - mass[at]) for _, y in same)
                weights.append(rest if rest > 1e-15 or (rest > 0 and not same) else 0.0)
                kept.append(same)
            u, k = random.random() * sum(weights), 0
            while k < len(weights) - 1 and u >= weights[k]:
                u -= weights[k]
                k += 1
            while not weights[k]:  # rounding at the end of the list
                k -= 1
            i, ids, w = edges[at][k]
            gone = kept[k]
            out.append(ids)
            log += w
            at = i
        return tuple(x for ids in reversed(out) for x in ids), log - mass[-1]

    def best(self, part: int, s: int) -> tuple[int, ...]:
        a = self.start[part, s]
        return tuple(self.flat[a : a + self.size[part, s]].tolist())

    def _text(self, ids) -> str:
        return b"".join([self.raw[k] for k in ids]).decode("utf-8", "replace")

    def decode(self, ids) -> str:
        """The text of pieces: exact for the pieces of a text without U+2581."""
        return self._text(ids).removeprefix(" ")


_VOCABULARIES: dict[tuple[str, float], Vocabulary] = worker_cache()


def vocabulary(path: str, alpha: float) -> Vocabulary:
    """The worker's vocabulary, kept from task to task."""
    if (path, alpha) not in _VOCABULARIES:
        _VOCABULARIES[path, alpha] = Vocabulary(path, alpha)
    return _VOCABULARIES[path, alpha]


class Parts:
    """What is known of the parts of some texts, or of one of them, in order; by segmentation, then part."""

    FIELDS = ("logs", "up_to", "rest")

    def __init__(self, words: Vocabulary, parts: np.ndarray, **known: np.ndarray):
        self.words, self.parts = words, parts
        known = known or {name: np.ascontiguousarray(getattr(words, name)[parts].T) for name in self.FIELDS}
        for name in self.FIELDS:
            setattr(self, name, known[name])

    def __getitem__(self, which: slice) -> Parts:
        return Parts(self.words, self.parts[which], **{name: getattr(self, name)[..., which] for name in self.FIELDS})

    def __len__(self) -> int:
        return len(self.parts)


def _ids(words: Vocabulary, parts: np.ndarray, choice: np.ndarray, odd: dict[int, tuple[int, ...]]) -> tuple[np.ndarray, np.ndarray]:
    """The ids of parts by the numbers of their segmentations, those in ``odd`` by place; and the number of ids of each part."""
    starts, sizes = words.start[parts, choice].astype(np.int64), words.size[parts, choice].astype(np.int64)
    if not odd:
        return words.flat[_ragged(starts, sizes)], sizes
    places = np.array(sorted(odd))
    sizes[places] = 0
    ids, ends, more = words.flat[_ragged(starts, sizes)], np.cumsum(sizes), [len(odd[k]) for k in places.tolist()]
    sizes[places] = more
    return np.insert(ids, np.repeat(ends[places], more), [x for k in places.tolist() for x in odd[k]]), sizes


class Segmentation:
    """A choice for every part: one of its best segmentations by number, or (BEST) another, in ``odd`` by place."""

    def __init__(self, choice: np.ndarray, logs: np.ndarray, odd: dict[int, tuple[int, ...]]):
        self.choice, self.logs, self.odd = choice, logs, odd

    def at(self, parts: Parts, k: int) -> tuple[int, ...]:
        return self.odd[k] if k in self.odd else parts.words.best(int(parts.parts[k]), int(self.choice[k]))

    def ids(self, parts: Parts) -> np.ndarray:
        return _ids(parts.words, parts.parts, self.choice, self.odd)[0]


def _fill(parts: Parts, out: Segmentation, start: int, random: np.random.Generator) -> None:
    """Draws the parts from ``start`` on by their probabilities."""
    u = random.random(len(parts) - start)
    choice = (u >= parts.up_to[:, start:]).view(np.int8).sum(axis=0, dtype=np.int8).astype(np.int64)
    out.choice[start:] = choice
    out.logs[start:] = parts.logs[np.minimum(choice, BEST - 1), np.arange(start, len(parts))]
    for k in ((choice == BEST).nonzero()[0] + start).tolist():
        part = int(parts.parts[k])
        out.odd[k], out.logs[k] = parts.words.draw(part, random, {parts.words.best(part, s) for s in range(BEST)})


def _left(parts: Parts, k: int, without: dict[tuple[int, ...], float]) -> tuple[list[int], np.ndarray, float]:
    """Of a part without some segmentations: its best ones that are left, their shares, the share of the others."""
    best = [parts.words.best(int(parts.parts[k]), s) for s in range(BEST)]
    share = np.exp(parts.logs[:, k])
    options = [s for s in range(BEST) if share[s] > 0 and best[s] not in without]
    gone = sum(p for w, p in without.items() if w not in best)
    other = float(parts.words.other[parts.parts[k]]) - gone
    return options, share[options], other if other > TINY else 0.0


def _below(key: float, drawn: float) -> float:
    """The largest perturbed value of a region, as ``drawn``, if it is to lie below ``key``."""
    return float(-np.logaddexp(-key, -drawn))


def sample(parts: Parts, k: int, random: np.random.Generator) -> list[tuple[Segmentation, float, float]]:
    """Up to k segmentations by falling key: (segmentation, log-probability, inclusion score)."""
    n, words = len(parts), parts.words
    base = Segmentation(np.zeros(n, np.int64), np.zeros(n), {})
    if not n:
        return [(base, 0.0, 1.0)]
    _fill(parts, base, 0, random)
    key, place, without = float(random.gumbel()), 0, {}  # a region: prefix of base up to place, there none of without
    found, splits, limit = [], [], -np.inf
    while True:
        found.append(base)
        # what is left of the region: by the first place, from ``place`` on, that differs from its segmentation
        logs = base.logs[place:]
        size = parts.rest[np.minimum(base.choice[place:], BEST - 1), np.arange(place, n)]
        taken = without | {base.at(parts, place): float(np.exp(logs[0]))}
        with np.errstate(divide="ignore"):
            for p in base.odd:
                if p > place:
                    other = words.other[parts.parts[p]] - np.exp(base.logs[p])
                    size[p - place] = np.log(np.exp(parts.logs[:, p]).sum() + (other if other >= TINY else 0.0))
            _, left, other = _left(parts, place, taken)
            size[0] = np.log(left.sum() + other)
        size += float(base.logs[:place].sum()) - logs + np.cumsum(logs)
        drawn = size - np.log(random.standard_exponential(len(size)))
        # keys lie below the one they were split from, in the order of what is drawn
        splits.append([_below(key, drawn.max()), key, drawn, base, place, taken])
        split = max(splits, key=lambda s: s[0])
        key, above, drawn, source, start, taken = split
        if len(found) == k:
            limit = key
            break
        if np.isneginf(key):
            break
        at = int(np.argmax(drawn))
        drawn[at] = -np.inf
        split[0] = _below(above, drawn.max())
        place = start + at
        without = taken if at == 0 else {source.at(parts, place): float(np.exp(source.logs[place]))}
        base = Segmentation(source.choice.copy(), source.logs.copy(), {p: v for p, v in source.odd.items() if p < place})
        options, share, other = _left(parts, place, without)
        pick = int(np.searchsorted(np.cumsum(share), random.random() * (share.sum() + other), "right"))
        if pick < len(options) or not other:
            pick = options[min(pick, len(options) - 1)]
            base.choice[place], base.logs[place] = pick, parts.logs[pick, place]
        else:
            part = int(parts.parts[place])
            base.choice[place] = BEST
            base.odd[place], base.logs[place] = words.draw(part, random, set(without) | {words.best(part, s) for s in range(BEST)})
        _fill(parts, base, place + 1, random)
    logs = [float(b.logs.sum()) for b in found]
    return [(b, log, 1.0 if np.isneginf(limit) else float(-np.expm1(-np.exp(min(50.0, log - limit))))) for b, log in zip(found, logs, strict=True)]


def segment(docs: DataFrame, model: str, *, keep: tuple[str, ...] = ("doc_id",), text: str = "text", key: str = "doc_id", samples: int = SAMPLES, alpha: float = 1.0, seed: int = SEED, digest: bool = False) -> DataFrame:
    """The columns of ``keep``, and ``ids`` (the library's encoding) and ``samples`` (array of ids, log_prob, inclusion).

    With ``digest``, ids are replaced by ``n_pieces`` and ``ids_crc32`` (of 32-bit little-endian ids), and ``exact``
    tells whether the encoding decodes to the text.
    """
    one = "n_pieces long, ids_crc32 long" if digest else "ids array<int>"
    rows = docs.select(*(F.col(f"`{c}`").alias(f"c{k}") for k, c in enumerate(keep)), F.coalesce(F.col(text), F.lit("")).alias("_text"), F.xxhash64(F.col(key), F.col(text)).alias("_key"))
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    schema = StructType([*rows.schema.fields[: len(keep)], *StructType.fromDDL(f"{one}{', exact boolean' if digest else ''}, samples array<struct<{one.replace(' ', ':').replace(',:', ', ')}, log_prob:double, inclusion:double>>").fields])
    target = to_arrow_schema(schema)

    def shown(many: list[np.ndarray]) -> list[pa.Array]:
        """Columns of id sequences."""
        sizes = np.array([len(x) for x in many], np.int64)
        if digest:
            return [pa.array(sizes), pa.array([zlib.crc32(x.astype("<i4")) for x in many], pa.int64())]
        return [pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(sizes)]), pa.int32()), pa.array(np.concatenate([np.zeros(0, np.int32), *many]), pa.int32()))]

    def split(ids: np.ndarray, sizes: np.ndarray, ends: np.ndarray) -> list[np.ndarray]:
        """The ids of each run of parts that ends before ``ends``."""
        return np.split(ids, np.concatenate([[0], np.cumsum(sizes)])[ends[:-1]]) if len(ends) else []

    def drawn_from(words: Vocabulary, numbers: np.ndarray, per_text: np.ndarray, keys: list[int]):
        """Of texts: the ids of the samples, one after the other, their log-probabilities and inclusions, samples per text."""
        parts, ends = Parts(words, numbers), np.cumsum(per_text)
        choices, owners, odd, stops, logs, inclusions, counts, done = [], [], {}, [], [], [], [], 0
        for n, end, key in zip(per_text.tolist(), ends.tolist(), keys, strict=True):
            own = parts[end - n : end]
            got = sample(own, samples, np.random.Generator(np.random.Philox(key=[key & 0xFFFFFFFFFFFFFFFF, seed])))
            for s, log, q in got:
                choices.append(s.choice)
                owners.append(own.parts)
                odd.update({done + k: ids for k, ids in s.odd.items()})
                done += n
                stops.append(done)
                logs.append(log)
                inclusions.append(q)
            counts.append(len(got))
        ids, sizes = _ids(words, np.concatenate(owners), np.concatenate(choices), odd)
        return split(ids, sizes, np.array(stops)), logs, inclusions, counts

    def run(batches):
        words = vocabulary(model, alpha)
        for batch in batches:
            offs = np.concatenate([[0], np.cumsum(pc.binary_length(batch.column("_text")).to_numpy(zero_copy_only=False), dtype=np.int64)])
            keys = batch.column("_key").to_pylist()
            for i, j in slices(offs, SLICE // 2):
                texts = batch.column("_text").slice(i, j - i).to_pylist()
                numbers, per_text = words.cut(texts)
                ends = np.cumsum(per_text)
                encoded = split(*_ids(words, numbers, np.full(len(numbers), BEST), {}), ends)
                fails = np.concatenate([[0], np.cumsum(~words.exact[numbers])])
                decodes = [a == b and SPACE not in t for a, b, t in zip(fails[ends - per_text].tolist(), fails[ends].tolist(), texts, strict=True)]
                drawn, logs, inclusions, counts, a = [], [], [], [], 0
                while a < j - i:
                    b = max(a + 1, int(np.searchsorted(ends, ends[a] - per_text[a] + TOGETHER, "right")))
                    got = drawn_from(words, numbers[ends[a] - per_text[a] : ends[b - 1]], per_text[a:b], keys[i + a : i + b])
                    for known, more in zip((drawn, logs, inclusions, counts), got, strict=True):
                        known += more
                    a = b
                inner = pa.StructArray.from_arrays([*shown(drawn), pa.array(logs, pa.float64()), pa.array(inclusions, pa.float64())], fields=list(target.field("samples").type.value_type))
                listed = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(counts)]), pa.int32()), inner).cast(target.field("samples").type)
                made = [*shown(encoded), *([pa.array(decodes)] if digest else []), listed]
                made = [x.cast(f.type) for x, f in zip(made, list(target)[len(keep) :], strict=True)]
                del inner, listed
                yield pa.RecordBatch.from_arrays([*(batch.column(c).slice(i, j - i) for c in range(len(keep))), *made], schema=target)
            del batch, made
        pa.default_memory_pool().release_unused()  # workers live on, and Arrow keeps the memory of a task's rows

    out = rows.mapInArrow(run, schema)
    return out.select(*(F.col(f"c{k}").alias(c) for k, c in enumerate(keep)), *out.columns[len(keep) :])
