"""The pipeline against plain Python, stage by stage, and its rows against brute force."""

import re
from collections import defaultdict

import corpus_pipeline
import public_tokenizers
import pytest
import regex
from tokenizers import Tokenizer

from tests_llm_brute import brute_components

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def stages(spark):
    from tessera.llm.common import staged
    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    out = [docs]
    for name, stage in corpus_pipeline.STAGES:
        out.append(staged(spark, stage(spark, out[-1], sf), "stage"))
    return out


def texts(df):
    return {r.doc_id: r.text for r in df.collect()}


def test_names_and_columns(stages):
    assert len(corpus_pipeline.STAGES) == 5
    assert all(df.columns == COLUMNS for df in stages[:-1])


def test_language_id_keeps_texts_with_letters(stages):
    assert texts(stages[1]) == {i: t for i, t in texts(stages[0]).items() if t and regex.search(r"\p{L}", t)}


def test_exact_dedup(stages):
    groups = defaultdict(list)
    for i, t in texts(stages[1]).items():
        groups[re.sub(r"[\x20\x09-\x0D]+", " ", t or "")].append(i)
    assert set(texts(stages[2])) == {min(g) for g in groups.values()}


def test_near_dedup(stages):
    rows = sorted(texts(stages[2]).items())
    assert set(texts(stages[3])) == {c for _, _, c in brute_components(rows)}


def test_decontamination(spark, stages):
    norm = lambda t: f" {' '.join((t or '').lower().split())} "
    items = [norm(r.text).strip() for r in spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet").collect()]
    before, after = texts(stages[3]), set(texts(stages[4]))
    assert set(before) - after == {i for i, t in before.items() if any(x in norm(t) for x in items)}


def test_packing(stages):
    t = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    want = {i: len(t.encode(x or "", add_special_tokens=False).ids) + 1 for i, x in texts(stages[4]).items()}
    got = defaultdict(int)
    for r in stages[5].collect():
        got[r.doc_id] += r.length
    assert got == want


def test_run(spark, stages):
    rows = corpus_pipeline.run(spark, "/root/testdata/sf0.001").drop("ids").collect()
    assert sorted(map(tuple, rows)) == sorted(map(tuple, stages[5].drop("ids").collect()))


def through(spark, docs):
    out = []
    for name, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, "/root/testdata/sf0.001")
        out.append(docs)
    return out


def test_defined_cases(spark, docs_of):
    prose = "once upon a time there was a river that ran slowly past the old mill and on to the sea"
    rows = [(i, f"{prose} number {i} of many {'so it goes ' * i}", "en", "web", 1) for i in range(12)]
    rows += [(100, None, "en", None, None), (101, "", "en", None, None), (102, "12 % --", "en", None, None), (103, "two words", None, None, None),
             (104, rows[3][1], "en", None, None), (3, rows[3][1], "en", "web", 1), (None, rows[5][1], "en", None, None), (None, "no id here", None, None, None),
             (105, "word " * 30_000, "en", None, None)]
    wide = "doc_id long, text string, lang string, source string, n_chars long, sha string, _bucket int, row string"
    docs = docs_of([(*r, "x", 7, "y") for r in rows], wide)
    stages = through(spark, docs)
    assert all(df.columns == docs.columns for df in stages[:-1])
    ids = [sorted((r.doc_id for r in df.select("doc_id").collect()), key=str) for df in stages[:-1]]
    assert ids[0] == sorted([*range(12), 103, 104, 3, None, None, 105], key=str)
    assert ids[1] == sorted([*range(12), 103, None, 105], key=str)  # equal texts, and the row that repeats, are one
    assert set(ids[2]) <= set(ids[1]) and {103, None, 105} <= set(ids[2]) and ids[3] == ids[2]
    assert {r.doc_id for r in stages[4].select("doc_id").collect()} == set(ids[3])


def test_empty_table(spark, docs_of):
    empty = docs_of([], "doc_id long, text string, lang string, source string, n_chars long, sha string")
    assert [df.count() for df in through(spark, empty)] == [0] * 5
    unlabelled = docs_of([(1, "some text", None, None, None)], "doc_id long, text string, lang string, source string, n_chars long")
    assert corpus_pipeline.language_id(spark, unlabelled, "/root/testdata/sf0.001").count() == 0
