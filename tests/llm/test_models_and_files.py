"""Operators 2, 4, 6, 8 and 9, and the pipeline's stages."""

import gc
import hashlib
import math
import random
import re
import tracemalloc
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from pitpanel.llm import license_texts, licenses, pieces, sketches, token_files, toxicity
from pitpanel.llm.queries import QUERIES
from pitpanel.llm.text import fresh_folder, stored
from tests.llm.test_text_operators import contaminated, near_duplicates, table, without_repeats

SF = "/root/testdata/sf0.01"


# -- 2

def ranked_right(scores, labels):
    """Share of pairs of a toxic and a clean text that the scores put in order (area under the curve)."""
    order = np.argsort(np.argsort(scores))
    ones = labels == 1
    return (order[ones].sum() - ones.sum() * (ones.sum() - 1) / 2) / (ones.sum() * (~ones).sum())


def test_toxicity_held_out_accuracy(spark):
    """Some labels are wrong, so held-out rows are judged by order and by a share that noise leaves within reach; rows that were learnt are not judged better."""
    folder = "/root/testdata/sf0.1"
    got = stored(QUERIES["op2_toxicity"](spark, folder), "test")
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    assert got.columns == ["doc_id", "held_out", "score", "predicted"] and got.count() == 10_000
    rows = got.join(labels, "doc_id").collect()
    right = {}
    for held in (True, False):
        own = [r for r in rows if r.held_out == held]
        scores, toxic = np.array([r.score for r in own]), np.array([r.toxic for r in own])
        assert ranked_right(scores, toxic) > 0.97
        right[held] = sum(r.predicted == r.toxic for r in own) / len(own)
    assert right[True] > 0.96 and right[False] - right[True] < 0.02
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in rows)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in got.collect())


def test_toxicity_does_not_learn_wrong_labels(spark):
    """A twentieth of the clean training texts is labelled toxic: the model keeps to the words that tell the classes apart."""
    rng = random.Random(4)
    words = ["".join(rng.choice("aeioulmnrst") for _ in range(rng.randint(3, 9))) for _ in range(4000)]
    rows = [(k, " ".join(rng.choice(words) for _ in range(40)) + (" vileword" if k % 8 == 0 else "")) for k in range(1600)]
    wrong = {k for k in range(1600) if k % 8 and rng.random() < 0.05}
    docs, labels = table(spark, rows), spark.createDataFrame([(k, int(k % 8 == 0 or k in wrong)) for k in range(1600)], "doc_id long, toxic int")
    got = {r.doc_id: r.predicted for r in toxicity.score(docs, toxicity.fit(toxicity.training_rows(docs, labels))).collect()}
    assert all(got[k] == 1 for k in range(0, 1600, 8))
    assert sum(got[k] for k in wrong) <= 1 and sum(got[k] for k in range(1600) if k % 8) <= 5


def test_toxicity_sample_takes_copies_once(spark):
    """A group of copies is one sampled text with a weight, so it cannot fill a class; ties of the hash stay together."""
    rng = random.Random(9)
    rows = [(k, f"good {' '.join(rng.choice('abcdefg') * 3 for _ in range(8))}") for k in range(300)] + [(1000 + k, "one copy vileword") for k in range(400)] + [(2000 + k, f"n{k} vileword") for k in range(60)]
    train = spark.createDataFrame([(t, int("vile" in t)) for _, t in rows], "text string, label int").withColumn("mark", F.xxhash64("text", "label")).repartition(4)
    telling = np.ones(1 << toxicity.BITS, bool)
    xs, y, weight = toxicity._sample(train, 50, 10**7, telling)
    assert (y == 1).sum() == (y == 0).sum() == 50 and len(xs) == 100
    assert sorted(weight)[-1] in (1.0, 400.0) and set(weight) <= {1.0, 400.0} | {float(k) for k in range(2, 10)}
    xs, y, weight = toxicity._sample(train, 61, 10**7, telling)
    assert weight[y == 1].sum() == 460
    model = toxicity.fit(train.drop("mark"), sample_rows=61)
    assert (model.scores(pa.array(["x vileword", "good"])) > 0.3).tolist() == [True, False]


def test_toxicity_edges(spark):
    words = ["good", "day", "sun", "tree", "cloud"]
    rng = random.Random(1)
    rows = [(k, " ".join(rng.choice(words) for _ in range(12)) + (" vileword" if k % 3 == 0 else "")) for k in range(120)]
    rows += [(500, None), (501, ""), (502, " \n"), (503, "x" * 200_000 + " vileword"), (None, "vileword")]
    docs = table(spark, rows)
    labels = spark.createDataFrame([(k, int(k % 3 == 0)) for k in range(120)] + [(0, 1), (1, None), (None, 1), (999, 1)], "doc_id long, toxic int").withColumn("text", F.lit("clash"))
    model = toxicity.fit(toxicity.training_rows(docs, labels))
    got = {r.doc_id: r for r in toxicity.score(docs, model).collect()}
    assert all(got[k].predicted == int(k % 3 == 0) for k in range(120))
    assert got[500].score == got[501].score == got[502].score < 0.3 < got[None].score
    assert toxicity.score(docs.limit(0), model).count() == 0
    only = toxicity.fit(toxicity.training_rows(docs, labels.where("toxic = 0")))
    scores = {r.score for r in toxicity.score(docs, only).collect()}
    assert len(scores) == 1 and max(scores) < 0.3
    assert 0 < toxicity.fit(toxicity.training_rows(docs, labels.limit(0))).scores(pa.array([None, "a"]))[0] < 1


# -- 4

def test_license_scan(spark):
    notices = license_texts.NOTICES
    rng = random.Random(2)
    filler = lambda: " ".join(rng.choice(["lorem", "ipsum", "the", "software", "license"]) for _ in range(40))
    rows, want = [], set()
    for k, (name, text) in enumerate(sorted(notices.items())):
        before = filler()
        rows.append((k, f"{before}. {text.upper()}\n{filler()}"))
        n = len(re.findall(r"[0-9a-z]+", text.lower()))
        want.add((k, name, n, 40, 40 + n))
    worn = notices["MIT permission"].split()
    for at in (5, 20, 33, 50, 61):
        worn[at] = "changed"
    del worn[40:43]
    rows += [(100, f"{filler()} {' '.join(worn)}"), (101, None), (102, ""), (103, "MIT"), (104, "Released under the MIT License. " * 3)]
    got = licenses.scan(table(spark, rows)).collect()
    assert {(r.doc_id, r.license, r.n_matched, r.start_word, r.end_word) for r in got if r.doc_id < 100} == want
    changed = [r for r in got if r.doc_id == 100]
    assert [r.license for r in changed] == ["MIT permission"] and 0.85 < changed[0].coverage < 0.95
    texts = dict(rows)
    for r in got:
        span = texts[r.doc_id][r.start_char : r.end_char]
        assert len(re.findall(r"[0-9a-z]+", span.lower())) == r.end_word - r.start_word
    assert [(r.start_word, r.end_word) for r in got if r.doc_id == 104] == [(0, 5), (5, 10), (10, 15)]
    assert not [r for r in got if r.doc_id in (101, 102, 103)]
    assert licenses.scan(table(spark, [])).count() == 0


def test_license_scan_does_not_misname_near_licenses(spark):
    gpl = license_texts.NOTICES["GPL-3.0+ notice"]
    wanted = {
        "Licensed under CC BY-ND 4.0.": ["CC-BY-ND-4.0 line"],
        "Licensed under CC BY-NC-ND 4.0.": ["CC-BY-NC-ND-4.0 line"],
        "This work is licensed under the GNU General Public License, version 2.": ["GPL-2.0 line"],
        gpl.replace("GNU General", "GNU Lesser General"): ["LGPL-3.0+ notice"],
        gpl.replace("GNU General", "GNU Affero General"): ["AGPL-3.0+ notice"],
        # without a template
        "Licensed under CC BY 1.0.": [],
        "Licensed under the Apache License, Version 1.1.": [],
        "Released under the Artistic License.": [],
        gpl.replace("version 3", "version 4"): [],
        gpl.replace("GNU General Public", "GNU Library General Public"): [],
        "Licensed under some terms that are much like CC and not by far 4.0.": [],
        # numbered conditions stay what they are
        license_texts.NOTICES["BSD-2-Clause conditions"].replace("Redistributions of", "1. Redistributions of").replace("Redistributions in", "2. Redistributions in"): ["BSD-2-Clause conditions"],
    }
    rows = list(enumerate(wanted))
    got = licenses.scan(table(spark, rows)).collect()
    assert {text: [r.license for r in got if r.doc_id == k] for k, text in rows} == wanted
    own = licenses.scan(table(spark, rows[:1]), {"BY": "Licensed under CC BY 4.0."}).collect()
    assert own == []


def test_license_alignment_is_the_best_local_one():
    rng = np.random.default_rng(3)

    def best(a, b):
        h = np.zeros((len(a) + 1, len(b) + 1), int)
        for i in range(len(a)):
            for j in range(len(b)):
                h[i + 1, j + 1] = max(0, h[i, j] + (1 if a[i] == b[j] else -1), h[i, j + 1] - 1, h[i + 1, j] - 1)
        return h.max()

    for _ in range(200):
        a, b = rng.integers(0, 4, rng.integers(1, 15)), rng.integers(0, 4, rng.integers(1, 25))
        matched, start, end = licenses.align(a, b, -40, 40)
        assert (matched == 0) == (best(a, b) == 0)
        assert not matched or best(a, b[start:end]) == best(a, b)


# -- 6

def shingles(text, n=5):
    w = re.findall(r"[^\x20\x09-\x0D]+", text.translate({65 + k: 97 + k for k in range(26)}))
    return {tuple(w[k : k + n]) for k in range(len(w) - n + 1)} if len(w) >= n else ({tuple(w)} if w else set())


def jaccard(a, b):
    return len(a & b) / len(a | b) if a | b else 1.0


@pytest.mark.parametrize("deal", [4000, 7])
def test_fingerprints(spark, deal):
    rng = random.Random(6)
    words = [f"w{k}" for k in range(500)] + ["Ñandú", "😀"]
    rows = [(5 * k, " ".join(rng.choice(words) for _ in range(rng.choice([1, 4, 5, 9, 40, 900])))) for k in range(40)]
    rows += [(1001, ""), (1002, None), (1003, rows[3][1]), (-7, "only one"), (1004, "z " * 3000 + "a b c")]
    got = {r.doc_id: r for r in sketches.edited_likeness(table(spark, rows), deal=deal).collect()}
    order = sorted(rows)
    for k, (i, text) in enumerate(order):
        text, after = text or "", order[(k + 1) % len(order)][1] or ""
        half = len(text) // 2
        edited = text[: len(text) - half] + after[:half]
        r = got[i]
        assert (r.n_chars, r.edited_sha256) == (len(text), hashlib.sha256(edited.encode()).hexdigest())
        small = len(shingles(text) | shingles(edited)) <= sketches.K
        assert abs(r.near_edited - jaccard(shingles(text), shingles(edited))) < (1e-9 if small else 0.2)
        assert abs(r.near_next - jaccard(shingles(text), shingles(after))) < 0.2
    assert got[1003].fingerprint == got[rows[3][0]].fingerprint and got[1001].fingerprint == got[1002].fingerprint == ""
    assert len(got[1004].fingerprint) == 16 * len(shingles(rows[-1][1]))


def test_sketches_merge_and_estimate(spark):
    rng = random.Random(7)
    a, b = (" ".join(f"v{rng.randrange(10**6)}" for _ in range(3000)) for _ in range(2))
    df = spark.createDataFrame([(a, b, f"{a} {b}")], "a string, b string, both string")
    x, y = sketches.sketch(F.col("a")), sketches.sketch(F.col("b"))
    r = df.select(x.alias("x"), sketches.merge(x, y).alias("m"), sketches.sketch(F.col("both")).alias("u"), sketches.distinct_count(x).alias("n"), sketches.containment(x, sketches.merge(x, y)).alias("c"), sketches.from_text(sketches.as_text(x)).alias("back")).first()
    assert len(set(r.m) & set(r.u)) >= sketches.K - 4  # the joined text has four shingles more
    assert abs(r.n / 2996 - 1) < 0.3 and r.c > 0.9 and r.back == r.x


def test_fingerprints_use_no_python(spark):
    plan = QUERIES["op6_fingerprints"](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", plan)
    assert sketches.edited_likeness(table(spark, [])).count() == 0


# -- 8

def test_elias_fano():
    rng = np.random.default_rng(1)
    for n in (1, 2, 255, 256, 257, 3000):
        for step in (0, 1, 50, 100_000):
            values = np.cumsum(rng.integers(0, step + 1, n))
            code = token_files.EliasFano.of(values)
            assert (code.all() == values).all()
            assert all(code.select(i) == values[i] for i in {0, n - 1, n // 2, *rng.integers(0, n, 20).tolist()})
            for a in {0, n // 3, n - 1, *rng.integers(0, n, 8).tolist()}:
                for b in {a, a + 1, n, min(n, a + 256), int(rng.integers(a, n + 1))}:
                    assert (code.between(a, b) == values[a:b]).all()
            bits = 8 * sum(p.nbytes for _, p in code.parts())
            assert bits <= n * (2.2 + max(0, math.log2(max(1, values[-1] / n)))) + 64


TEXTS = ["", " ", "   ", "a  b \n\n c", "x'll 's  \t", "\u0085 x\u0085 y 12 3", "é é à " * 50, "<|endoftext|> a <|endoftext|>", "日本 語 x", "The end."]


def test_token_files(spark):
    path = public_tokenizers.path("byte_bpe_50k.json")
    tokenizer = token_files.encoder(path).tokenizer
    rows = [(7 * k % 31, t) for k, t in enumerate(TEXTS)] + [(100, None), (101, "w " * 60_000), (None, "null id")]
    docs = table(spark, rows)
    manifest = token_files.write(docs, fresh_folder(spark, "ids"), path, partitions=3)
    got = token_files.read(spark, manifest).collect()
    start, want = 0, []
    for i, text in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0)):
        ids = tokenizer.encode(text or "", add_special_tokens=False).ids + [0]
        want.append((i, start, len(ids), zlib.crc32(np.array(ids, "<u4"))))
        start += len(ids)
    assert sorted(map(tuple, got), key=lambda r: r[1]) == want
    some = token_files.TokenFile(manifest.orderBy("part").first().path)
    assert some.ids(some.n_docs - 1)[-1] == 0 and len(some.ids(0)) == want[0][2]
    assert token_files.round_trip(docs.limit(0), path).count() == 0


def test_token_files_equal_whole_text_encoding(spark):
    got = {r.doc_id: r for r in QUERIES["op8_token_files"](spark, SF).collect()}
    path = public_tokenizers.path("byte_bpe_50k.json")
    docs = spark.read.parquet(f"{SF}/documents.parquet").where("doc_id % 9 = 0").collect()
    for d in docs:
        ids = token_files.encoder(path).tokenizer.encode(d.text, add_special_tokens=False).ids + [0]
        assert (got[d.doc_id].n_tokens, got[d.doc_id].ids_crc32) == (len(ids), zlib.crc32(np.array(ids, "<u4")))


def test_token_files_equal_a_fresh_tokenizer_with_added_tokens(spark):
    from tokenizers import Tokenizer

    path = public_tokenizers.path("byte_bpe_50k.json")
    tokenizer = Tokenizer.from_file(path)
    assert tokenizer.encode("a b <|endoftext|> c", add_special_tokens=False).ids == [64, 275, 220, 50256, 269]
    end = "<|endoftext|>"
    texts = [*TEXTS, f"a b {end} c", end, f"a{end}b", f"{end}{end}", f" {end}  x", f"x \n {end}\n\ny {end}", f"é{end} é", f"日本{end}語", f"< {end}> <|endoftext |>", f"w {end} " * 5_000]
    rows = list(enumerate(texts))
    got = {r.doc_id: r for r in token_files.round_trip(table(spark, rows), path, partitions=3).collect()}
    start = 0
    for k, text in rows:
        ids = tokenizer.encode(text, add_special_tokens=False).ids + [0]
        assert tuple(got[k]) == (k, start, len(ids), zlib.crc32(np.array(ids, "<u4"))), text[:40]
        start += len(ids)
    coder = token_files.Encoder(path)
    assert coder.bytes_of[50256] == len(end)
    data = np.frombuffer("".join(texts).encode(), np.uint8)
    assert coder.encode(data, np.array([0, len(data)]))[0].tolist() == tokenizer.encode("".join(texts), add_special_tokens=False).ids


# -- 9

MODEL = public_tokenizers.path("piece_bpe_32k.model")


def every_segmentation(words, text):
    text, out = pieces.SPACE + text.replace(" ", pieces.SPACE), []

    def go(at, ids, log):
        if at == len(text):
            out.append((tuple(ids), log))
        for end in range(at + 1, min(len(text), at + 16) + 1):
            k = words.pieces.get(text[at:end])
            if k is not None:
                go(end, [*ids, k], log + words.weight[k])
            elif end == at + 1:
                raw = text[at:end].encode()
                go(end, ids + [words.byte_ids[b] for b in raw], log + len(raw) * words.byte_weight)

    go(0, [], 0.0)
    total = np.logaddexp.reduce([log for _, log in out])
    return {ids: log - total for ids, log in out}


@pytest.mark.parametrize("alpha", [0.1, 1.0])
@pytest.mark.parametrize("text", ["the cat", "a", "䷿x", "thing ab"])
def test_sampled_segmentations_follow_their_probabilities(alpha, text):
    words = pieces.vocabulary(MODEL, alpha)
    want, rounds = every_segmentation(words, text), 1200
    numbers, _ = words.cut([text])
    parts = pieces.Parts(words, numbers)
    first, whole = {}, 0.0
    for r in range(rounds):
        got = pieces.sample(parts, 3, np.random.Generator(np.random.Philox(key=[r, 5])))
        ids = [tuple(s.ids(parts).tolist()) for s, _, _ in got]
        assert len(set(ids)) == len(ids) == min(3, len(want))
        assert all(words.decode(i) == text for i in ids)
        assert all(abs(want[i] - log) < 1e-6 for i, (_, log, _) in zip(ids, got, strict=True))
        first[ids[0]] = first.get(ids[0], 0) + 1
        whole += sum(math.exp(log) / q for _, log, q in got)  # an unbiased estimate of 1
    assert all(abs(math.exp(log) - first.get(i, 0) / rounds) < 0.06 for i, log in want.items())
    assert abs(whole / rounds - 1) < 0.06


def test_pieces_round_trip(spark):
    rows = [(k, t) for k, t in enumerate(TEXTS)] + [(50, None), (51, "😀 \x00z"), (52, "w " * 20_000), (0, TEXTS[0])]
    docs = table(spark, rows)
    words = pieces.vocabulary(MODEL, 1.0)
    for r in pieces.segment(docs, MODEL).collect():
        text = dict(rows)[r.doc_id] or ""
        assert r.ids == words.model.encode(text) and words.decode(r.ids) == text
        assert all(words.decode(s.ids) == text and 0 < s.inclusion <= 1 for s in r.samples)
        assert len({tuple(s.ids) for s in r.samples}) == len(r.samples) >= 1
    again = pieces.segment(docs.repartition(5), MODEL, digest=True)
    assert sorted(map(str, again.collect())) == sorted(map(str, pieces.segment(docs, MODEL, digest=True).collect()))
    assert pieces.segment(docs.limit(0), MODEL).count() == 0


def random_words(n, seed=4):
    """Texts of made-up words, nearly all of them parts not met before."""
    rng = random.Random(seed)
    return [" ".join("".join(rng.choice("etaoinshrdlu") for _ in range(rng.randint(2, 24))) for _ in range(100)) for _ in range(n // 100)]


def test_parts_kept_in_a_worker_take_flat_arrays():
    """What a worker keeps adds up over its tasks: numbers in arrays, no objects for each part."""
    words = pieces.Vocabulary(MODEL, 1.0)
    words.cut(random_words(2000, 5))
    gc.collect()
    tracemalloc.start()
    words.cut(random_words(30_000))
    gc.collect()
    kept, _ = tracemalloc.get_traced_memory()
    tracemalloc.stop()
    assert words.rows > 30_000 and kept < 15e6  # 12 MB; with strings and dictionaries of parts 18 MB


def test_new_parts_of_all_lengths_are_learnt_together(monkeypatch):
    """A text's few new parts of each length must not cost a run of small steps for every length."""
    words, runs, plain = pieces.Vocabulary(MODEL, 1.0), [], pieces.Vocabulary._lattice
    monkeypatch.setattr(pieces.Vocabulary, "_lattice", lambda self, *more: runs.append(1) or plain(self, *more))
    numbers, _ = words.cut(random_words(1000))
    assert len(set(numbers.tolist())) > 500 and len(runs) == 1


def test_parts_learnt_side_by_side_are_as_alone():
    """Masses and best segmentations do not depend on what else is learnt, nor on what was dropped in between."""
    texts = [*random_words(1000), "a", "", "䷿x\n\n", "\n", "😀 \x00z", "e" * 3000, "▁ the  cat"]
    together = pieces.Vocabulary(MODEL, 1.0)
    numbers, per_text = together.cut(texts)
    ends = np.cumsum(per_text)
    alone = pieces.Vocabulary(MODEL, 1.0)
    for text, end, n in zip(texts[-12:], ends[-12:], per_text[-12:], strict=True):
        alone.clear()
        own, _ = alone.cut([text])
        for a, b in zip(numbers[end - n : end].tolist(), own.tolist(), strict=True):
            for name in ("logs", "other", "up_to", "rest", "exact", "size"):
                np.testing.assert_allclose(getattr(together, name)[a], getattr(alone, name)[b], rtol=1e-9, atol=1e-12)
            assert [together.best(a, s) for s in range(pieces.BEST + 1)] == [alone.best(b, s) for s in range(pieces.BEST + 1)]


# -- pipeline

def test_pipeline_stages_against_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    benchmark = [tuple(r) for r in spark.read.parquet(f"{SF}/benchmark.parquet").select("item_id", "text").collect()]
    benchmark = [(str(i), t) for i, t in benchmark]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stored(stage(spark, docs, SF), "pipeline-test")
        assert out.schema == docs.schema
        before, after = ({r.doc_id: r for r in d.collect()} for d in (docs, out))
        rows = [(r.doc_id, r.text) for r in before.values()]
        assert all(after[i] == before[i] or name == "substring_dedup" for i in after)
        if name == "toxicity":
            labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
            held = {i: t for i, t in labels.items() if zlib.crc32(str(i).encode()) % 4 == 2}  # never learnt
            clean, toxic = ([i for i, t in held.items() if t == k] for k in (0, 1))
            assert sum(i in after for i in clean) > 0.97 * len(clean) and sum(i not in after for i in toxic) > 0.5 * len(toxic)
        elif name == "ngram_join":
            assert set(after) == {i for i, _, c in near_duplicates(rows) if i == c}
        elif name == "substring_dedup":
            for i, n, removed, kept in without_repeats(rows):
                assert after[i].text == (kept if removed else before[i].text) and after[i].n_chars == len(after[i].text)
        else:
            assert set(after) == {r[0] for r in contaminated(rows, benchmark) if not r[5]}
        docs = out
    final = corpus_pipeline.STAGES[-1][1](spark, docs, SF).collect()
    words = pieces.vocabulary(MODEL, 1.0)
    texts = {r.doc_id: r.text for r in docs.collect()}
    assert {r.doc_id for r in final} == set(texts)
    assert all(words.decode(r.ids) == texts[r.doc_id] == words.decode(r.samples[0].ids) for r in final)
