"""License scan: winnowed fingerprints pick candidate places, banded sequence alignment decides them.

Templates and texts are sequences of lower-cased alphanumeric words.  Of every ``WINDOW`` consecutive hashed
``GRAM``-word runs the smallest is a fingerprint (winnowing), so a text and a template that share at least
``GRAM + WINDOW - 1`` words share a fingerprint.  The inverted index of the templates' fingerprints gives (template,
place) candidates; hits on nearby diagonals form one candidate region, which a local alignment (match 1, mismatch and
gap -1) of template and text inside a band around these diagonals turns into matched words and a span.  The templates
are configuration, bounded by ``MOST_TEMPLATE_WORDS``, and go to every task; the corpus is scanned once, unshuffled.

A match needs every deciding word of its template: numbers, the words of ``DECIDING``, and those in which it differs from
a near template; and holds no such word besides (numbers excepted).  In templates of up to ``SHORT`` words, other words
between the matched ones count as missed.  So near licenses without a template are left out and not misnamed.

Reported are matches that cover at least ``COVERAGE`` of their template; of overlapping spans the one with most matched
words stays (then larger coverage, then name).  Defined cases: null and empty texts match nothing; templates without
words are ignored; shorter templates than a fingerprint needs are one run of all their words; repeated rows are scanned
each; an empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pitpanel.llm.license_texts import NOTICES
from pitpanel.llm.text import U64, Words, alphanumeric_words, grams, slices, sliding_min, utf8

GRAM, WINDOW = 3, 2
BAND = 8
COVERAGE = 0.75
MOST_TEMPLATE_WORDS = 2_000_000
#: In templates of at most so many words, other words between the matched ones count against the coverage.
SHORT = 16
#: Words that tell licenses apart, also from such as no template knows.
DECIDING = (
    "affero agpl apache artistic boost bsd cc0 cddl eclipse epl eupl fdl gfdl gpl isc lesser lgpl mit mozilla mpl unlicense zlib "
    "nc nd sa noncommercial noderivatives noderivs sharealike derivatives"
).split()


def fingerprints(words: Words, gram: int, window: int) -> tuple[np.ndarray, np.ndarray]:
    """(hash, first word) of the winnowed fingerprints of every row; rows too short for a window give their smallest run."""
    every = grams(words.hash, gram)
    n = len(every)
    inside = words.row[:n] == words.row[gram - 1 : gram - 1 + n]
    low, at = sliding_min(every, window)
    whole = (words.row[: len(low)] == words.row[gram + window - 2 : gram + window - 2 + len(low)]) if len(low) else np.zeros(0, bool)
    chosen = at[whole]
    short = np.flatnonzero(inside & (words.per_row[words.row[:n]] < gram + window - 1)) if n else np.zeros(0, np.int64)
    places = np.unique(np.concatenate([chosen, short])).astype(np.int64)
    return every[places], places


class Index:
    """Inverted index of the fingerprints of templates."""

    def __init__(self, templates: dict[str, str], gram: int = GRAM, window: int = WINDOW, coverage: float = COVERAGE):
        self.names = sorted(templates)
        data, offs = utf8(pa.array([templates[k] for k in self.names], pa.large_string()))
        words = Words(data, offs, 0, len(self.names), alphanumeric_words(), lower=True)
        if len(words.hash) > MOST_TEMPLATE_WORDS:
            raise ValueError(f"templates have more than {MOST_TEMPLATE_WORDS} words")
        self.gram, self.window = gram, window
        self.words = [words.hash[words.first[k] : words.first[k + 1]] for k in range(len(self.names))]
        marks, places = fingerprints(words, gram, window)
        template, place = words.row[places], places - words.first[words.row[places]]
        tiny = [k for k, w in enumerate(self.words) if 0 < len(w) < gram]  # found by their first word
        marks = np.concatenate([marks, np.array([self.words[k][0] for k in tiny], U64)])
        template, place = np.concatenate([template, np.array(tiny, np.int64)]), np.concatenate([place, np.zeros(len(tiny), np.int64)])
        order = np.argsort(marks, kind="stable")
        self.marks, self.template, self.place = marks[order], template[order], place[order]
        self.tiny = bool(tiny)
        self._tell_apart(data, words, coverage)

    def _tell_apart(self, data: np.ndarray, words: Words, coverage: float) -> None:
        """Places that a match of each template needs (``needed``), and words that it must not hold besides (``strange``)."""
        known, offs = utf8(pa.array([" ".join(DECIDING)], pa.large_string()))
        deciding = Words(known, offs, 0, 1, alphanumeric_words(), lower=True).hash
        number = np.array([data[x:y].tobytes().isdigit() for x, y in zip(words.starts.tolist(), words.ends.tolist(), strict=True)], bool)
        self.needed, self.strange = [], []
        for k, own in enumerate(self.words):
            needed = np.isin(own, deciding) | number[words.first[k] : words.first[k + 1]]
            strange = [deciding]
            for j, other in enumerate(self.words):  # templates whose text would pass as this one
                if j == k or not len(own) or np.isin(own, other).sum() < coverage * len(own):
                    continue
                got = pairs(own, other, -len(own), len(other))
                if len(got) >= coverage * len(own):
                    inside = np.ones(len(own), bool)
                    inside[[x for x, _ in got]] = False
                    needed |= inside
                    between = np.delete(other, [y for _, y in got if y >= 0])[got[0][1] : got[-1][1] + 1 - len(got)]
                    strange.append(np.setdiff1d(between, own))
            self.needed.append(needed)
            self.strange.append(np.unique(np.concatenate(strange)))

    def fits(self, k: int, text: np.ndarray, got: list[tuple[int, int]], coverage: float) -> bool:
        """Whether matched places (template, text) are a match of template k."""
        own, place = np.array(got).T
        start, end = int(place[0]), int(place[-1]) + 1
        size = len(self.words[k])
        if len(got) < coverage * (max(size, end - start) if size <= SHORT else size):
            return False
        left = np.ones(size, bool)
        left[own] = False
        if (left & self.needed[k]).any():
            return False
        return not np.isin(np.delete(text[start:end], place - start), self.strange[k]).any()

    def hits(self, words: Words) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(first word, template, place in it) of every shared fingerprint."""
        marks, at = fingerprints(words, self.gram, self.window)
        if self.tiny:
            marks, at = np.concatenate([marks, words.hash]), np.concatenate([at, np.arange(len(words.hash))])
        low, high = np.searchsorted(self.marks, marks, "left"), np.searchsorted(self.marks, marks, "right")
        found = np.flatnonzero(high > low)
        size = (high - low)[found]
        entry = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size) + np.repeat(low[found], size)
        return np.repeat(at[found], size), self.template[entry], self.place[entry]


def pairs(template: np.ndarray, text: np.ndarray, low: int, high: int) -> list[tuple[int, int]]:
    """Places (template, text) of the words matched by the best local alignment with diagonals (text - template place) low..high."""
    m, width = len(template), high - low + 1
    score = np.zeros((m + 1, width + 2), np.int32)  # column c + 1: text place i + low + c before word i of the template
    bias = np.arange(width, dtype=np.int32)
    for i in range(m):
        place = i + low + bias
        inside = (place >= 0) & (place < len(text))
        same = np.zeros(width, bool)
        same[inside] = text[place[inside]] == template[i]
        straight = score[i, 1:-1] + np.where(same, 1, -1)  # aligns word i with the text's word
        skip = np.append(score[i, 2:-1], 0) - 1  # template word without a partner: one diagonal to the left
        best = np.where(inside, np.maximum(np.maximum(straight, skip), 0), 0)
        # text words without a partner: along the row, one point each
        score[i + 1, 1:-1] = np.maximum(best, np.maximum.accumulate(best + bias) - bias)
    i, c = np.unravel_index(int(np.argmax(score)), score.shape)
    if not score[i, c]:
        return []
    out = []
    while score[i, c] > 0:
        place = i - 1 + low + c - 1  # the text's word of this cell
        here = score[i, c]
        hit = 0 <= place < len(text) and text[place] == template[i - 1]
        if here == score[i - 1, c] + (1 if hit else -1):
            if hit:
                out.append((i - 1, int(place)))
            i -= 1
        elif c + 1 <= width and here == score[i - 1, c + 1] - 1:
            i, c = i - 1, c + 1
        elif c > 1 and here == score[i, c - 1] - 1:
            c -= 1
        else:
            break
        if i == 0:
            break
    return out[::-1]


def align(template: np.ndarray, text: np.ndarray, low: int, high: int) -> tuple[int, int, int]:
    """Matched words, first and end word (of the text) of that alignment."""
    got = pairs(template, text, low, high)
    return (len(got), got[0][1], got[-1][1] + 1) if got else (0, 0, 0)


def scan_row(index: Index, text: np.ndarray, at: np.ndarray, template: np.ndarray, place: np.ndarray, band: int, coverage: float) -> list[tuple[int, int, int, int]]:
    """(template, matched words, first word, end word) of one text's matches; the hits' places count from its first word."""
    diagonal = at - place
    order = np.lexsort((diagonal, template))
    template, diagonal = template[order], diagonal[order]
    fresh = np.ones(len(order), bool)
    bands = np.minimum(band, np.maximum(1, np.array([len(index.words[k]) // 4 for k in template])))  # repeats of a short template stay apart
    fresh[1:] = (template[1:] != template[:-1]) | (diagonal[1:] > diagonal[:-1] + bands[1:])
    first = np.flatnonzero(fresh)
    last = np.append(first[1:], len(order)) - 1
    found = []
    for a, b in zip(first, last, strict=True):
        words = index.words[template[a]]
        low, high = int(diagonal[a] - bands[a]), int(diagonal[b] + bands[a])
        begin = max(0, low)
        own = text[begin : high + len(words) + 1]
        if np.isin(words, own).sum() < coverage * len(words):  # as many can match at most
            continue
        got = pairs(words, own, low - begin, high - begin)
        if got and index.fits(int(template[a]), own, got, coverage):
            found.append((int(template[a]), len(got), got[0][1] + begin, got[-1][1] + 1 + begin))
    found.sort(key=lambda x: (-x[1], -x[1] / len(index.words[x[0]]), index.names[x[0]], x[2]))
    kept: list[tuple[int, int, int, int]] = []
    for x in found:
        if all(x[3] <= y[2] or y[3] <= x[2] for y in kept):
            kept.append(x)
    return sorted(kept, key=lambda x: x[2])


def scan(docs: DataFrame, templates: dict[str, str] | None = None, *, doc_id: str = "doc_id", text: str = "text", band: int = BAND, coverage: float = COVERAGE) -> DataFrame:
    """``doc_id, license, n_matched, coverage, start_word, end_word, start_char, end_char`` of every match (ends exclusive)."""
    index = Index(NOTICES if templates is None else templates, coverage=coverage)
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    names = ["doc_id", "license", "n_matched", "coverage", "start_word", "end_word", "start_char", "end_char"]

    def run(batches):
        table = alphanumeric_words()
        for batch in batches:
            data, offs = utf8(batch.column("text"))
            out = []
            for i, j in slices(offs):
                words = Words(data, offs, i, j, table, lower=True)
                at, template, place = index.hits(words)
                order = np.argsort(words.row[at], kind="stable")
                at, template, place = at[order], template[order], place[order]
                edges = np.searchsorted(words.row[at], np.arange(j - i + 1))
                for r in np.flatnonzero(np.diff(edges)):
                    a, b = edges[r], edges[r + 1]
                    base, end = words.first[r], words.first[r + 1]
                    chars = lambda byte, r=r, words=words: len(words.data[words.offs[r] : byte].tobytes().decode())
                    for k, matched, x, y in scan_row(index, words.hash[base:end], at[a:b] - base, template[a:b], place[a:b], band, coverage):
                        out.append((i + r, index.names[k], matched, matched / len(index.words[k]), x, y, chars(words.starts[base + x]), chars(words.ends[base + y - 1])))
            columns = list(zip(*out, strict=True)) if out else [[]] * 8
            yield pa.RecordBatch.from_arrays([batch.column("doc_id").take(pa.array(columns[0], pa.int64())), pa.array(columns[1], pa.string()), pa.array(columns[2], pa.int64()), pa.array(columns[3], pa.float64()), *(pa.array(c, pa.int64()) for c in columns[4:])], names=names)

    return rows.mapInArrow(run, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, license string, n_matched long, coverage double, start_word long, end_word long, start_char long, end_char long")
