"""The pipeline's stages on nulls, empty and long texts, repeated ids and rows, clashing column names and an empty table."""

import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from pitpanel.llm import ngram_join, pieces, toxicity
from pitpanel.llm.text import fresh_folder, stored

CLASHES = ("score", "predicted", "class", "root", "mark", "n_words", "kept", "spans", "n_hit", "_id")
STAGE = dict(corpus_pipeline.STAGES)
rng = random.Random(21)
WORDS = [f"w{k}" for k in range(4000)]


def text(n=40):
    return " ".join(rng.choice(WORDS) for _ in range(n))


NEAR, PASSAGE, ITEM, LONG = text(60), text(30), text(12), text(40_000)
ROWS = [(k, text() + (" vileword" if k % 4 == 0 else ""), "en", "s", 1) for k in range(200)]
EDGES = [(1000, None, None, None, None), (1001, "", "en", None, 0), (None, "lone row without an id", None, "s", 1), (1002, "  \n", "en", "s", 3),
         (1003, NEAR, "en", "s", 1), (1004, NEAR + " x", "en", "s", 1), (1004, text(), "en", "s", 1), (1005, LONG, None, "s", 1),
         (1006, "equal rows " + ITEM[:0], "en", "s", 1), (1006, "equal rows " + ITEM[:0], "en", "s", 1),
         (1007, f"{text(5)} {PASSAGE} {text(5)}", "en", "s", 1), (1008, f"{text(7)} {PASSAGE}", "en", "s", 1), (1009, f"{text(9)} {ITEM} {text(3)}", "en", "s", 1)]


@pytest.fixture(scope="module")
def tables(spark):
    folder = fresh_folder(spark, "edges")
    spark.createDataFrame([(k, 1, int(k % 4 == 0)) for k in range(200)] + [(1000, 1, None), (None, 0, 1)], "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame([("a", ITEM), ("b", None), (None, ""), ("c", "nowhere to be found in these rows at all, not even once")], "item_id string, text string").write.parquet(f"{folder}/benchmark.parquet")
    docs = spark.createDataFrame(ROWS + EDGES, "doc_id long, text string, lang string, source string, n_chars long")
    docs = docs.select(*(F.lit(k).alias(c) for k, c in enumerate(CLASHES)), *docs.columns)
    return folder, stored(docs.repartition(3), "edges-docs")


def rows_of(df):
    return sorted(((r.doc_id, r.text) for r in df.collect()), key=str)


def test_stages_keep_columns_and_clean_rows(spark, tables):
    folder, docs = tables
    every = rows_of(docs)
    clean = {}
    for name in ("toxicity", "ngram_join", "substring_dedup", "decontamination"):
        out = stored(STAGE[name](spark, docs, folder), "edges-out")
        assert out.schema == docs.schema
        assert [r[: len(CLASHES)] for r in out.select(*CLASHES).distinct().collect()] == [tuple(range(len(CLASHES)))]
        clean[name] = rows_of(out)
    assert clean["toxicity"] == [r for r in every if "vileword" not in (r[1] or "")]
    once = [r for k, r in enumerate(every) if r != (1004, NEAR + " x") and not (r[0] == 1006 and every[k - 1] == r)]
    assert clean["ngram_join"] == once
    cut = dict(r for r in clean["substring_dedup"] if r[0] in (1007, 1008))
    assert PASSAGE in cut[1007] and cut[1008] == dict(every)[1008].replace(" " + PASSAGE, "")
    # the near copy is a repeated passage too; nothing else changes
    changed = {r[0] for r in set(every) ^ set(clean["substring_dedup"])}
    assert changed == {1004, 1008} and len(clean["substring_dedup"]) == len(every)
    assert clean["decontamination"] == [r for r in every if r[0] != 1009]


def test_pieces_of_edge_rows_decode_to_their_texts(spark, tables):
    import public_tokenizers

    from pitpanel.llm import pieces

    folder, docs = tables
    words = pieces.vocabulary(public_tokenizers.path("piece_bpe_32k.model"), 1.0)
    some = docs.where("doc_id IS NULL OR doc_id >= 1000 AND doc_id != 1005")
    got = STAGE["sentencepiece"](spark, some, folder).collect()
    assert sorted((r.doc_id, words.decode(r.ids)) for r in got if r.doc_id is not None) == sorted((i, t or "") for i, t, *_ in EDGES if i is not None and i != 1005)
    assert sum(r.doc_id is None for r in got) == 1
    assert all(words.decode(s.ids) == words.decode(r.ids) for r in got for s in r.samples)
    assert max(len(r.samples) for r in got) > 1


def test_stages_of_an_empty_table(spark, tables):
    folder, docs = tables
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs.limit(0), folder)
        assert out.count() == 0 and (name == "sentencepiece" or out.columns == docs.columns)


def test_a_unit_without_anything_recurring_and_one_text_column(spark):
    """Units of which no hash recurs give no rows; the text crosses the documents' exchange once."""
    from pitpanel.llm import substring_dedup

    rows = [(k, " ".join(f"w{k}x{i}" for i in range(40))) for k in range(6)] + [(6, None), (7, "short")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r for r in substring_dedup.dedup(df.repartition(3)).collect()}
    assert [got[k].n_words for k in range(8)] == [40] * 6 + [0, 1] and not any(r.n_removed for r in got.values())
    assert all(got[k].kept == t for k, t in rows if t) and got[6].text is None
    assert substring_dedup._rows(df, "doc_id", "text").columns == ["c0", "_text", "_id", "_hash"]


@pytest.mark.parametrize("step", [lambda docs: ngram_join.shingle_classes(docs), lambda docs: toxicity.score(docs, toxicity.Model(0.0, np.zeros(1 << toxicity.BITS)))])
def test_tasks_drop_what_other_operators_left_in_their_worker(spark, monkeypatch, step):
    """Workers live on from stage to stage: the parts that sentencepiece keeps must not lie on top of what other steps need."""
    docs = spark.createDataFrame([(1, "a b c d e f")], "doc_id long, text string")
    steps, plain = [], type(docs).mapInArrow
    monkeypatch.setattr(type(docs), "mapInArrow", lambda self, f, *more: steps.append(f) or plain(self, f, *more))
    step(docs)
    monkeypatch.setitem(pieces._VOCABULARIES, ("model", 0.1), object())
    assert not list(steps[0](iter([])))   # a task without rows
    assert not pieces._VOCABULARIES
