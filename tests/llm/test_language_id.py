import random

import pytest

from tessera.llm.language_id import drop_unidentified, fit, identify, predict, train
SF = "/root/testdata/sf0.001"


def test_held_out_accuracy(spark):
    docs = spark.read.parquet(f"{SF}/../sf0.01/documents.parquet")
    got = identify(spark, docs).join(docs.select("doc_id", "lang"), "doc_id").filter("held_out").collect()
    assert len(got) > 150
    assert sum(r.lang_pred == r.lang for r in got) / len(got) >= 0.97
    assert all(0 <= r.score <= 1 for r in got)


def test_defined_cases(spark, docs_of):
    rng = random.Random(2)
    a, b = ["uno", "dos", "tres", "cuatro", "año"], ["one", "two", "three", "four", "five"]
    rows = [(i, " ".join(rng.choice(a if i % 2 else b) for _ in range(30)), "es" if i % 2 else "en") for i in range(80)]
    rows += [(100, None, "es"), (101, "", "en"), (102, "12 %% ½ --", "en"), (103, "año año", None), (None, "three four", None),
             (104, "uno dos " * 40_000, None), (104, "uno dos " * 40_000, None)]
    docs = docs_of(rows, "doc_id long, text string, lang string, lang_pred string, score string")
    got = identify(spark, docs).collect()
    assert len(got) == len(rows)
    by = {r.doc_id: r for r in got}
    assert [by[i].lang_pred for i in (100, 101, 102, 103, None, 104)] == ["und", "und", "und", "es", "en", "es"]
    assert by[None].held_out is False and by[100].score == 0
    kept = drop_unidentified(spark, docs)
    assert kept.columns == docs.columns and kept.count() == len(rows) - 3


@pytest.mark.parametrize("rows", [[], [(1, "some text", None), (2, None, None)]])
def test_nothing_to_learn_from(spark, docs_of, rows):
    docs = docs_of(rows, "doc_id long, text string, lang string")
    assert [r.lang_pred for r in identify(spark, docs).collect()] == ["und"] * len(rows)
    assert drop_unidentified(spark, docs).count() == 0


def test_families_then_pairs():
    import numpy as np
    from tessera.llm.language_id import features
    rng = random.Random(3)
    words = {"a1": "ab abc bca", "a2": "ab abd dba", "b1": "xy xyz zyx", "b2": "xy xyw wyx"}
    texts = [(k, " ".join(rng.choice(v.split()) for _ in range(20))) for k, v in words.items() for _ in range(30)]
    model = train(np.array([k for k, _ in texts], object), np.concatenate(list(features([t for _, t in texts]))))
    assert sorted(map(sorted, model.families)) == [["a1", "a2"], ["b1", "b2"]]
    assert predict(model, [t for _, t in texts])[0] == [k for k, _ in texts]


def test_copies_do_not_thin_the_sample(spark, docs_of):
    """Languages of many copies of few texts, or of texts mostly without letters, are all learned."""
    words = {"en": ["one", "two"], "es": ["uno", "dos"], "de": ["eins", "zwei"]}
    rows = [(None, f"{w} {w} {w}", lang) for lang, ws in words.items() for w in ws for _ in range(20_000 if lang != "de" else 1)]
    rows += [(None, str(i), "de") for i in range(40_000)]
    docs = docs_of(rows, "doc_id long, text string, lang string")
    model = fit(spark, docs.select("text", "lang"))
    assert model is not None and sorted(sum(model.families, [])) == ["de", "en", "es"]
    texts = [f"{w} {w} {w}" for ws in words.values() for w in ws]
    assert predict(model, texts)[0] == [lang for lang, ws in words.items() for _ in ws]


def test_every_labelled_language_is_learned(spark, docs_of):
    """150 languages, each with its own way of making words, in 30 groups of related ones."""
    rng = random.Random(6)
    group = lambda g: [chr(0x400 + 7 * g + i) for i in range(7)]
    words = {}
    for n in range(150):
        letters = group(n // 5)
        words[f"l{n:03d}"] = ["".join(rng.choice(letters) for _ in range(4)) for _ in range(12)]
    rows = [(lang, " ".join(rng.choice(ws) for _ in range(30))) for lang, ws in words.items() for _ in range(12)]
    docs = docs_of([(None, t, lang) for lang, t in rows], "doc_id long, text string, lang string")
    model = fit(spark, docs.select("text", "lang"))
    assert sorted(sum(model.families, [])) == sorted(words) and max(map(len, model.families)) <= 12
    fresh = [(lang, " ".join(rng.choice(ws) for _ in range(30))) for lang, ws in words.items()]
    got = predict(model, [t for _, t in fresh])[0]
    assert sum(g == lang for g, (lang, _) in zip(got, fresh)) >= 147


def test_score_decides_in_the_pipeline(spark, docs_of, monkeypatch):
    import tessera.llm.language_id as L
    rng = random.Random(2)
    a, b = ["uno", "dos", "tres", "cuatro"], ["one", "two", "three", "four"]
    docs = docs_of([(i, " ".join(rng.choice(a if i % 2 else b) for _ in range(30)), "es" if i % 2 else "en") for i in range(80)],
                   "doc_id long, text string, lang string")
    assert L.drop_unidentified(spark, docs).count() == 80
    monkeypatch.setattr(L, "MIN_SCORE", 1.1)
    assert L.drop_unidentified(spark, docs).count() == 0
