"""Operators 11, 12 and 13 against brute force on small tables with nulls, ties, repeats and clashing columns."""

import hashlib
import random
import re
import zlib
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from pitpanel.llm import merkle, minhash, whitening
from pitpanel.llm.queries import QUERIES
from tests.llm.test_text_operators import lower, table

SF = "/root/testdata/sf0.001"


# -- 11

def H(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf_of(row, text):
    return H(*("-" if v is None else f"{len(str(v).encode())}:{v}" for v in (*row[:4], text)))


def tree(digests):
    """The top and, for each leaf, its runs bottom up with its place in each."""
    paths, at = [[] for _ in digests], list(range(len(digests)))
    while len(digests) > 1:
        for k, path in enumerate(paths):
            first = at[k] - at[k] % 3
            path.append((digests[first : first + 3], at[k] % 3))
            at[k] //= 3
        digests = [H(*digests[k : k + 3]) for k in range(0, len(digests), 3)]
    return digests[0], paths


def manifest(rows):
    """rows: (doc_id, source, lang, n_chars, text)"""
    own = [leaf_of(r, r[4]) for r in rows]
    groups = defaultdict(list)
    for k, r in enumerate(rows):
        groups[r[1]].append(k)
    subroots, paths = {}, {}
    for source, members in groups.items():
        members.sort(key=lambda k: (rows[k][0] is not None, rows[k][0] or 0, own[k]))
        subroots[source], found = tree([own[k] for k in members])
        paths.update(zip(members, found, strict=True))
    order = sorted(subroots, key=lambda s: (s is not None, (s or "").encode()))
    root, above = tree([subroots[s] for s in order])
    out = []
    for k, r in enumerate(rows):
        path, text = paths[k] + above[order.index(r[1])], r[4]
        if text is not None and r[0] is not None and zlib.crc32(str(r[0]).encode()) % 2 == 0:
            text = text.replace("\n", "")
        folded = leaf_of(r, text)
        for run, place in path:
            folded = H(*run[:place], folded, *run[place + 1 :])
        beside = [x for run, place in path for j, x in enumerate(run) if j != place]
        out.append((r[0], own[k], subroots[r[1]], root, "".join(beside), folded, folded == root))
    return out


def rows_of(df):
    return sorted(((r.doc_id, r.leaf, r.subroot, r.root, r.siblings, r.folded_root, r.verified) for r in df.collect()), key=str)


COLUMNS = "doc_id long, source string, lang string, n_chars long, text string"
EDGES = [(1, "en", "x", 3, "a\nb"), (2, None, None, None, None), (None, None, "q", 2, "q\n"), (2, "de", "", 0, ""), (2, "de", "", 0, ""), (7, "de", "é", 2, "é\n"), (-5, "", "", 1, "\n"), (9, "en", "x", 200_000, "w\n" * 100_000)]


@pytest.mark.parametrize(("levels", "partitions"), [(1, 3), (6, 4)])
def test_manifest_of_edge_cases(spark, levels, partitions):
    rows = EDGES + [(100 + k, "en", "x", 4, f"t{k}\n") for k in range(40)]
    docs = spark.createDataFrame(rows, COLUMNS).withColumns({c: F.lit(1) for c in ("tree", "leaf", "block", "n")}).repartition(3)
    got = merkle.manifest(docs, tampered=merkle.without_line_feeds(), levels=levels, partitions=partitions)
    assert rows_of(got) == sorted(manifest(rows), key=str)
    assert {r[0] for r in rows_of(got) if not r[-1]} == {i for i, *_, t in rows if t and "\n" in t and i is not None and zlib.crc32(str(i).encode()) % 2 == 0}


def test_manifest_of_many_sources_and_of_one_row(spark):
    rows = [(k, f"s{k % 90}", "en", k, f"x\n{k}") for k in range(200)]
    docs = spark.createDataFrame(rows, COLUMNS)
    assert rows_of(merkle.manifest(docs, tampered=merkle.without_line_feeds(), levels=1, partitions=5)) == sorted(manifest(rows), key=str)
    one = merkle.manifest(spark.createDataFrame(EDGES[:1], COLUMNS)).first()
    assert one.leaf == one.subroot == one.root == one.folded_root and one.siblings == "" and one.verified
    assert merkle.manifest(spark.createDataFrame([], COLUMNS)).count() == 0


def test_any_change_is_found(spark):
    rows = [(k, f"s{k % 4}", "en", k, f"text {k}") for k in range(60)]
    docs = spark.createDataFrame(rows, COLUMNS)
    got = merkle.manifest(docs, tampered=F.when(F.col("doc_id") == 17, F.lit("other")).otherwise(F.col("text")), levels=2).collect()
    assert [r.doc_id for r in got if not r.verified] == [17]
    assert all(merkle.fold(r.leaf, r.steps, r.siblings) == r.root for r in got)


# -- 12

def near_duplicates(rows, n=4, percent=80):
    sets, found = [], defaultdict(list)
    for _, text in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", lower(text or ""))
        sets.append({tuple(w[k : k + n]) for k in range(len(w) - n + 1)} if len(w) >= n else ({tuple(w)} if w else set()))
    part = list(range(len(rows)))

    def root(x):
        while part[x] != x:
            x = part[x]
        return x

    for k, own in enumerate(sets):
        shared = defaultdict(int)
        for gram in own:
            for j in found[gram]:
                shared[j] += 1
            found[gram].append(k)
        for j, m in shared.items():
            if 100 * m >= percent * (len(own) + len(sets[j]) - m):
                part[root(k)] = root(j)
    least = {}
    for k, (i, _) in enumerate(rows):
        if i is not None:
            least[root(k)] = min(least.get(root(k), i), i)
    return [(i, len(sets[k]), least.get(root(k)), i == least.get(root(k))) for k, (i, _) in enumerate(rows)]


def near_copies(seed):
    rng = random.Random(seed)
    words, rows = [f"w{k}" for k in range(3000)] + ["É", "ñandú"], []
    for length in (3, 4, 5, 12, 60, 200, 200):
        base = [rng.choice(words) for _ in range(length)]
        for _ in range(50):
            own = list(base)
            for _ in range(rng.choice([0, 0, 1, 2, 3, 5, 8])):
                own[rng.randrange(length)] = rng.choice(words)
            rows.append((3 * len(rows) + 1, " ".join(own)))
    rows += [(2, None), (5, ""), (8, " \n"), (11, "One"), (14, "oNE"), (17, "z " * 70), (20, "z " * 45), (None, rows[0][1]), (None, "alone here"), rows[3], rows[3]]
    return rows + [(23, " ".join(rng.choice(words) for _ in range(60_000)))]


@pytest.mark.parametrize("piece", [512, 3])
def test_minhash_components(spark, piece):
    rows = near_copies(piece)
    got = minhash.near_duplicates(table(spark, rows), piece=piece).select("doc_id", "n_shingles", "component_id", "kept").collect()
    assert sorted(map(tuple, got), key=str) == sorted(near_duplicates(rows), key=str)


def test_minhash_of_many_short_texts(spark):
    rng = random.Random(8)
    rows = [(k, " ".join(rng.choice("abcdefgh") for _ in range(rng.choice([1, 2, 4, 5, 6, 9])))) for k in range(6000)]
    got = minhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)).select("doc_id", "n_shingles", "component_id", "kept").collect()
    assert sorted(map(tuple, got)) == sorted(near_duplicates(rows))


def test_minhash_of_nothing(spark):
    docs = table(spark, near_copies(1)[:5])
    assert minhash.near_duplicates(docs.limit(0)).count() == 0
    alone = minhash.near_duplicates(table(spark, [(4, None), (None, ""), (6, "a")])).collect()
    assert {(r.doc_id, r.n_shingles, r.component_id, r.kept) for r in alone} == {(4, 0, 4, True), (None, 0, None, True), (6, 1, 6, True)}


def test_sketches_fill_agree_and_concentrate():
    rng = np.random.default_rng(3)
    t, off = 252, []
    for common, own in ((0, 1), (1, 0), (3, 1), (40, 10), (500, 100), (90, 800)):
        pool = rng.integers(0, 1 << 63, common + 2 * own).astype(np.uint64)
        a, b = np.sort(pool[: common + own]), np.sort(np.concatenate([pool[:common], pool[common + own :]]))
        s = minhash.sketches(np.array([len(a), len(b), 0]), np.concatenate([a, b]), t)
        assert (s[:2] != minhash._EMPTY).all() and (s[2] == minhash._EMPTY).all()
        off.append(abs((s[0] == s[1]).mean() - common / (common + 2 * own)))
        assert (minhash.sketches(np.array([len(a)]), a[::-1].copy(), t)[0] == s[0]).all()
    assert max(off) < 4 * 0.5 / np.sqrt(t)
    buckets = minhash.bands(s, 42, 6)
    assert buckets.shape == (3, 42) and len(np.unique(buckets)) == 126


# -- 13

def whitening_of(vectors):
    x = np.array([[int(np.floor(1024 * float(c))) + 100_000 for c in v] for v in vectors])
    n, s = len(x), x.sum(axis=0)
    y = x - s / n
    _, sigma, axes = np.linalg.svd(y / np.sqrt(n), full_matrices=False)  # keeps small eigenvalues exact
    return ((n * x - s) ** 2).sum(axis=1), y, sigma**2, axes.T


def compare(got, ids, vectors, k, close=1e-7):
    deviation, y, values, axes = whitening_of(vectors)
    assert len(got) == len(ids) * k
    for c in range(k):
        own = {r.vec_id: r for r in got if r.component == c + 1}
        want = y @ axes[:, c] / np.sqrt(values[c])
        have = np.array([own[i].whitened for i in ids])
        assert min(np.abs(have - want).max(), np.abs(have + want).max()) < close
        assert all(own[i].deviation == d and own[i].n == len(ids) for i, d in zip(ids, deviation.tolist(), strict=True))
        assert max(abs(own[i].explained * values.sum() / values[c] - 1) for i in ids) < 1e-7
        assert max(own[i].identity_error for i in ids) < 1e-7


def test_whitening_of_the_given_vectors(spark):
    got = QUERIES["op13_whitening"](spark, SF).collect()
    rows = [r for r in spark.read.parquet(f"{SF}/embeddings.parquet").collect() if r.embedding and all(c is not None and np.isfinite(c) for c in r.embedding)]
    compare(got, [r.vec_id for r in rows], [r.embedding for r in rows], 8)


def test_whitening_of_badly_conditioned_vectors(spark):
    rng = np.random.default_rng(5)
    base = rng.normal(size=(300, 6)) * [3000.0, 40.0, 3.0, 0.5, 0.2, 0.1]
    vectors = (base @ np.linalg.qr(rng.normal(size=(6, 6)))[0]).tolist()
    nan, inf = float("nan"), float("inf")
    bad = [None, [], [1.0, nan, 0, 0, 0, 0], [inf] * 6, [None, 1.0, 1, 1, 1, 1], [1e300] + [0.0] * 5, [1.0, 2.0]]
    rows = [(k, [float(c) for c in v]) for k, v in enumerate(vectors)] + [(1000 + k, None if v is None else [None if c is None else float(c) for c in v]) for k, v in enumerate(bad)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumns({c: F.lit(1) for c in ("x", "width", "n", "sums")}).repartition(5)
    got = whitening.whitened(df).collect()
    compare(got, list(range(300)), vectors, 6)


def test_whitening_without_variance(spark):
    schema = "vec_id long, embedding array<float>"
    same = spark.createDataFrame([(k, [1.0, 2.0]) for k in range(5)], schema)
    for df in (same, same.limit(1), same.limit(0), spark.createDataFrame([(1, None), (2, [])], schema)):
        assert whitening.whitened(df).count() == 0
    line = spark.createDataFrame([(k % 7 or None, [float(k), 2.0, float(2 * k)]) for k in range(20)], schema)
    got = whitening.whitened(line).collect()
    assert {r.component for r in got} == {1} and len(got) == 20 and {round(r.explained, 12) for r in got} == {1.0} and sum(r.vec_id is None for r in got) == 3


def test_deviations_are_exact():
    x = np.array([[1 << 40, -(1 << 40)], [3, 5]])
    s = np.array([int(v) for v in x.sum(axis=0)], object)
    want = [[10**7 * int(v) - int(t) for v, t in zip(row, s, strict=True)] for row in x]
    d = whitening.deviations(x, 10**7, s)
    assert d.tolist() == want
    with pytest.raises(OverflowError):
        whitening.squares(d)
    assert whitening.squares(np.array([[1 << 30, 3]])).tolist() == [(1 << 60) + 9]
