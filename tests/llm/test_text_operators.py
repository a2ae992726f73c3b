"""Operators 5, 7 and 10 against brute force on small tables with nulls, ties, repeats and clashing columns."""

import hashlib
import random
import re

import pytest
from pyspark.sql import functions as F

from pitpanel.llm import decontaminate, ngram_join, substring_dedup
from pitpanel.llm.text import stored

WHITE = r"[^\x20\x09-\x0D]+"
ALNUM = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def lower(text):
    return text.translate({65 + k: 97 + k for k in range(26)})


def table(spark, rows, schema="doc_id long, text string"):
    """A stored table in several files, with columns whose names clash with the operators' own."""
    df = spark.createDataFrame(rows, schema)
    df = df.select("*", *(F.lit(k).alias(c) for k, c in enumerate(("class", "tokens", "n", "items", "_id", "_hash", "spans", "c0", "score"))))
    return stored(df.repartition(3), "test")


def corpus(seed, n=90, vocabulary=3000):
    rng = random.Random(seed)
    words = [f"w{k}" for k in range(vocabulary)] + ["É", "ñandú", "A", "a"]
    bases = [[rng.choice(words) for _ in range(rng.choice([3, 5, 6, 30, 60, 90]))] for _ in range(6)]
    rows = []
    for k in range(n):
        own = list(rng.choice(bases))
        for _ in range(rng.choice([0, 0, 1, 1, 2, 4])):
            own[rng.randrange(len(own))] = rng.choice(words)
        if rng.random() < 0.3:
            own += rng.choice(bases)
        rows.append((3 * k + 1, rng.choice([" ", "  ", "\n"]).join(own)))
    rows += [(2, None), (5, ""), (8, " \t\n"), (11, "One"), (14, "oNE"), (17, "a b c"), (20, "A  b C"), (23, "z " * 70), (26, "z " * 45), rows[0], (29, "x\u00a0y\u2003z")]
    return rows


def near_duplicates(rows):
    sets = []
    for _, text in rows:
        w = re.findall(WHITE, lower(text or ""))
        sets.append({tuple(w[k : k + 5]) for k in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set()))
    part = list(range(len(rows)))

    def root(x):
        while part[x] != x:
            x = part[x]
        return x

    for a in range(len(sets)):
        for b in range(a):
            if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b]):
                part[root(a)] = root(b)
    least = {}
    for k, (i, _) in enumerate(rows):
        least[root(k)] = min(least.get(root(k), i), i)
    return sorted((i, len(sets[k]), least[root(k)]) for k, (i, _) in enumerate(rows))


@pytest.mark.parametrize("block", [512, 3])
def test_ngram_join_components(spark, block):
    rows = corpus(1)
    got = ngram_join.near_duplicates(table(spark, rows), block=block).select("doc_id", "n_shingles", "component_id")
    assert sorted(map(tuple, got.collect())) == near_duplicates(rows)


def test_ngram_join_keeps_one_and_all_columns(spark):
    rows = corpus(2, 40)
    docs = table(spark, rows)
    kept = ngram_join.keep_one(docs)
    assert kept.columns == docs.columns
    # repeated rows of a component's first document: one of them stays
    assert sorted(r.doc_id for r in kept.collect()) == sorted({i for i, _, c in near_duplicates(rows) if i == c})


def test_ngram_join_empty_and_null_ids(spark):
    assert ngram_join.near_duplicates(table(spark, [])).count() == 0
    rows = [(None, "a b c d e f"), (7, "a b c d e f"), (4, "A B c d e f"), (None, None)]
    got = ngram_join.near_duplicates(table(spark, rows)).select("doc_id", "component_id").collect()
    assert sorted(map(tuple, got), key=str) == sorted([(None, 4), (7, 4), (4, 4), (None, None)], key=str)


def test_trie_prunes_and_finds_all():
    import numpy as np

    rng = np.random.default_rng(5)
    base = rng.integers(0, 10**9, 300)
    sets = []
    for _ in range(60):
        keep = base[rng.random(300) > rng.choice([0.02, 0.1, 0.3])]
        sets.append(np.unique(np.concatenate([keep, rng.integers(0, 10**9, int(rng.integers(1, 40)))])).astype(np.uint64))
    sizes = np.array([len(s) for s in sets])
    trie = ngram_join.Trie(sets, sizes)
    for x in range(len(sets)):
        got = {trie.order[y] for y in trie.links(x, np.ones(len(sets), bool), 75)}
        own = sets[trie.order[x]]
        want = {y for y, s in enumerate(sets) if 100 * len(np.intersect1d(own, s)) >= 75 * len(np.union1d(own, s))}
        assert got == want


def without_repeats(rows, size=20):
    order = sorted(set(rows), key=lambda r: (r[0] is not None, r[0], r[1]))
    seen, gone = {}, {}
    for i, text in order:
        w = re.findall(WHITE, text or "")
        for k in range(len(w) - size + 1):
            if tuple(w[k : k + size]) in seen:
                gone.setdefault((i, text), set()).update(range(k, k + size))
            seen.setdefault(tuple(w[k : k + size]), (i, k))
    out = []
    for i, text in rows:
        w = re.findall(WHITE, text or "")
        own = gone.get((i, text), set())
        out.append((i, len(w), len(own), " ".join(x for k, x in enumerate(w) if k not in own)))
    return sorted(out, key=str)


@pytest.mark.parametrize("hot", [5000, 2])
def test_substring_dedup(spark, hot):
    rows = corpus(3)
    got = substring_dedup.dedup(table(spark, rows), hot=hot)
    assert got.columns[0] == "doc_id" and got.columns[-3:] == ["n_words", "n_removed", "kept"]
    got = got.select("doc_id", "n_words", "n_removed", "kept").collect()
    want = without_repeats(rows)
    assert sorted(map(tuple, got), key=str) == want
    assert sum(x[2] for x in want) > 500


def test_substring_dedup_null_id_first_and_empty(spark):
    text = " ".join(f"k{n}" for n in range(25))
    got = substring_dedup.dedup(table(spark, [(3, text), (None, text), (1, "x " + text)])).select("doc_id", "n_removed").collect()
    assert {(r.doc_id, r.n_removed) for r in got} == {(None, 0), (1, 25), (3, 25)}
    assert substring_dedup.dedup(table(spark, [])).count() == 0


def contaminated(rows, items, window=10):
    out = []
    parts = [(i or "", re.findall(ALNUM, lower(t or ""))) for i, t in items]
    for i, text in rows:
        w, hit, found = re.findall(ALNUM, lower(text or "")), set(), set()
        for name, item in parts:
            size = min(window, len(item))
            runs = {tuple(item[k : k + size]) for k in range(len(item) - size + 1)} if size else set()
            for k in range(len(w) - size + 1):
                if size and tuple(w[k : k + size]) in runs:
                    hit.update(range(k, k + size))
                    found.add(name)
        names = ",".join(sorted(found))
        out.append((i, len(w), len(hit), len(found), hashlib.sha256(names.encode()).hexdigest(), bool(hit)))
    return sorted(out, key=str)


@pytest.mark.parametrize("block_chars", [10**6, 40])
def test_decontamination(spark, block_chars):
    rng = random.Random(4)
    words = "alpha beta gamma Delta 7 x1 é ß the of".split()
    items = [(str(k), " ".join(rng.choice(words) for _ in range(rng.choice([0, 1, 4, 9, 10, 11, 25])))) for k in range(12)]
    items += [(None, "null id item has its words"), ("13", None), ("1", items[1][1]), ("dup", items[3][1])]
    rows = []
    for k in range(60):
        own = [rng.choice(words) for _ in range(rng.randrange(0, 40))]
        if rng.random() < 0.6:
            own[5:5] = (rng.choice(items)[1] or "").upper().replace("É", "é").split()
        rows.append((k, rng.choice([" ", ", ", "-"]).join(own)))
    rows += [(100, None), (101, ""), (102, "Null-ID item: has its words!"), rows[0]]
    docs, bench = table(spark, rows), table(spark, items, "item_id string, text string")
    got = decontaminate.report(decontaminate.mark(docs, bench, block_chars=block_chars)).collect()
    want = contaminated(rows, items)
    assert sorted(map(tuple, got), key=str) == want
    kept = decontaminate.remove_contaminated(docs, bench, block_chars=block_chars)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted(x[0] for x in want if not x[5])


def test_decontamination_longest_matches(spark):
    item = [f"q{k}" for k in range(30)]
    text = ["a"] * 4 + item[3:20] + ["b"] + item[:12] + ["c"]
    docs, bench = table(spark, [(1, " ".join(text))]), table(spark, [("i", " ".join(item))], "item_id string, text string")
    got = {tuple(r) for r in decontaminate.matches(docs, bench).collect()}
    assert got == {(1, "i", 4, 3, 17), (1, "i", 22, 0, 12)}


def test_decontamination_empty(spark):
    docs, none = table(spark, [(1, "a b")]), table(spark, [], "item_id string, text string")
    assert [(r.n_words, r.n_hit) for r in decontaminate.mark(docs, none).collect()] == [(2, 0)]
    assert decontaminate.mark(table(spark, []), none).count() == 0


def test_keep_one_decides_by_id_and_text(spark):
    rng = random.Random(12)
    text = lambda: " ".join(rng.choice([f"w{k}" for k in range(3000)]) for _ in range(40))
    a, b, c, d, e = (text() for _ in range(5))
    rows = [(1, a), (5, a + " x"), (5, b),          # a clean row shares its id with a near copy
            (7, c), (7, c), (7, c), (8, c),          # repeated rows: one stays
            (None, d), (None, d + " y"), (None, e), (3, e),   # null ids: one of d, none of e
            (9, None), (9, ""), (9, None)]           # no words: all stay
    got = sorted(map(str, ((r.doc_id, r.text) for r in ngram_join.keep_one(table(spark, rows)).collect())))
    options = [sorted(map(str, [(1, a), (5, b), (7, c), (None, x), (3, e), (9, None), (9, ""), (9, None)])) for x in (d, d + " y")]
    assert got in options
    docs = table(spark, corpus(4))
    kept = ngram_join.keep_one(docs)
    assert kept.columns == docs.columns
    assert sorted({r.doc_id for r in kept.collect()}) == sorted({i for i, _, c in near_duplicates(corpus(4)) if i == c})
    assert ngram_join.keep_one(docs.limit(0)).count() == 0


def test_only_the_automata_locate_passages(monkeypatch):
    import ahocorasick
    import numpy as np

    words = " ".join(f"w{k}" for k in range(30)).encode()
    other = words + b" z"
    found = lambda *places: np.array(list(places), substring_dedup.OCCURRENCE).tobytes()
    rows = [(1, 0, False, words, found((1, 5, 0), (2, 6, 3))), (1, 0, False, other, found((3, 7, 0)))]
    out = substring_dedup._located(rows, 20).to_pylist()
    got = {(r["_id"], r["start"] + k) for r in out for k in range(r["windows"])}
    assert got == {(2, 3 + k) for k in range(11)} | {(3, k) for k in range(11)}
    empty = ahocorasick.Automaton()
    monkeypatch.setattr(substring_dedup, "automaton", lambda *patterns: empty)
    assert substring_dedup._located(rows, 20).num_rows == 0
