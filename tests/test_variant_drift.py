"""Paths, types and drift of schema-on-read documents."""

import json

import pytest
from pyspark.sql import functions as F

from tessera.operators import variant_drift as V


def documents(spark, batches):
    rows = [(n, json.dumps(d)) for n, b in enumerate(batches) for d in b]
    return spark.createDataFrame(rows, "batch_id int, t string").select("batch_id", F.parse_json("t").alias("raw"))


def test_paths_types_and_documents(spark):
    docs = [{"a": 1, "b": [{"c": 1, "d": "x"}, {"c": 2.5}]}, {"a": None, "b": []}, {"a": 2, "b": [{"c": 1e300}], "e": {"f": {"g": [[1], [True]]}}}, {}]
    got = {r["path"]: (r["type"], r["docs"], r["share"]) for r in V.profile(documents(spark, [docs])).collect()}
    assert got == {
        "$": ("OBJECT", 4, 1.0), "$.a": ("BIGINT", 3, 0.75), "$.b": ("ARRAY", 3, 0.75), "$.b[]": ("OBJECT", 2, 0.5),
        "$.b[].c": ("DOUBLE", 2, 0.5), "$.b[].d": ("STRING", 1, 0.25), "$.e": ("OBJECT", 1, 0.25), "$.e.f": ("OBJECT", 1, 0.25),
        "$.e.f.g": ("ARRAY", 1, 0.25), "$.e.f.g[]": ("ARRAY", 1, 0.25), "$.e.f.g[][]": ("VARIANT", 1, 0.25)}


@pytest.mark.parametrize("seen, type_", [
    ([], "VOID"), (["VOID"], "VOID"), (["VOID", "STRING"], "STRING"), (["BIGINT", "DECIMAL"], "DECIMAL"), (["DOUBLE", "BIGINT"], "DOUBLE"),
    (["BIGINT", "STRING"], "VARIANT"), (["OBJECT", "ARRAY"], "VARIANT"), (["VARIANT", "BIGINT"], "VARIANT")])
def test_lattice(spark, seen, type_):
    df = spark.createDataFrame([(seen,)], "t array<string>")
    assert df.select(V.least_above(F.col("t"))).first()[0] == type_


def test_drift_between_batches(spark):
    batches = [[{"k": 1, "old": True}], [{"k": 2, "new": "x"}, {"k": 3}], [{"k": 2.5, "new": "y"}], [{"k": "text", "new": "z"}], [{"k": 1, "new": None}]]
    got = sorted(map(tuple, V.drift(V.profile(documents(spark, batches))).collect()), key=str)
    assert got == sorted([
        (1, "$.new", "added", None, "STRING", None, 0.5), (1, "$.old", "gone", "BOOLEAN", None, 1.0, None),
        (2, "$.k", "widened", "BIGINT", "DECIMAL", 1.0, 1.0), (3, "$.k", "changed", "DECIMAL", "STRING", 1.0, 1.0),
        (4, "$.k", "changed", "STRING", "BIGINT", 1.0, 1.0), (4, "$.new", "narrowed", "STRING", "VOID", 1.0, 1.0)], key=str)


def test_nothing(spark):
    assert V.profile(documents(spark, [[]])).count() == 0 and V.drift(V.profile(documents(spark, [[{"a": 1}]]))).count() == 0


def test_documents_are_not_moved(spark):
    """Only counts are shuffled: no row of a shuffle names a document."""
    df = V.profile(documents(spark, [[{"a": [{"b": n}, {"b": "x"}]} for n in range(50)], [{"a|b": None, "c": {"d": []}}]]))
    plan = df._sc._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")
    assert "_doc" not in plan and "partial_count" in plan
    assert sorted(tuple(r)[:4] for r in df.collect()) == [
        (0, "$", "OBJECT", 50), (0, "$.a", "ARRAY", 50), (0, "$.a[]", "OBJECT", 50), (0, "$.a[].b", "VARIANT", 50),
        (1, "$", "OBJECT", 1), (1, "$.a|b", "VOID", 1), (1, "$.c", "OBJECT", 1), (1, "$.c.d", "ARRAY", 1)]


def test_documents_are_read_once_however_deep(spark):
    """No job runs before the profile itself, and that reads each document once, for counts and shares alike."""
    deep = {"a": 1}
    for _ in range(40):
        deep = {"a": [deep, deep["a"]]} if len(json.dumps(deep)) < 500 else {"a": deep}
    docs, read = documents(spark, [[deep, {"a": []}, {"a": [[None]]}], [deep]]), spark.sparkContext.accumulator(0)

    def counted(batches):
        for b in batches:
            read.add(b.num_rows)
            yield b
    spark.sparkContext.setJobGroup("profile", "profile")
    try:
        df = V.profile(docs.mapInArrow(counted, docs.schema))
        assert not spark.sparkContext.statusTracker().getJobIdsForGroup("profile")
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    for n, asked in enumerate((df, df.select("path"), df.select("path", "type", "docs"), df.select("share"))):
        assert len(asked.collect()) > 40 and read.value == 4 * (n + 1)
    assert df.count() > 40 and read.value == 20


def test_types_that_merging_the_elements_of_an_array_hides(spark):
    """Texts of schema_of_variant merge elements: to VARIANT without their paths, to DOUBLE or TIMESTAMP of other types, of null and none alike."""
    texts = ['{"a": [{"b": [1]}, [true], 2]}', '{"a": []}', '{"a": [null]}', '{"d": [0.00000000000000000000000000000000001, 9223372036854775807]}',
             '{"d": [], "e": [[], []]}', '{"e": [[], [null]]}', '{"x`y": {"ARRAY<VOID>: ": 1, "": 2, "c, d": 1.5, "k.l": 1}, "x`y.k": {"l": "s"}}']
    cast = spark.sql("SELECT to_variant_object(named_struct('f', array(CAST(1 AS VARIANT), CAST(CAST(1 AS FLOAT) AS VARIANT)), "
                     "'t', array(CAST(DATE'2020-01-01' AS VARIANT), CAST(TIMESTAMP'2020-01-01 00:00:00' AS VARIANT)))) AS raw")
    raw = spark.createDataFrame([(t,) for t in texts], "t string").select(F.parse_json("t").alias("raw")).unionByName(cast)
    got = {r["path"]: (r["type"], r["docs"]) for r in V.profile(raw.withColumn("batch_id", F.lit(0))).collect()}
    assert got == {
        "$": ("OBJECT", 8), "$.a": ("ARRAY", 3), "$.a[]": ("VARIANT", 2), "$.a[].b": ("ARRAY", 1), "$.a[].b[]": ("BIGINT", 1), "$.a[][]": ("BOOLEAN", 1),
        "$.d": ("ARRAY", 2), "$.d[]": ("DECIMAL", 1), "$.e": ("ARRAY", 2), "$.e[]": ("ARRAY", 2), "$.e[][]": ("VOID", 1),
        "$.x`y": ("OBJECT", 1), "$.x`y.ARRAY<VOID>: ": ("BIGINT", 1), "$.x`y.": ("BIGINT", 1), "$.x`y.c, d": ("DECIMAL", 1),
        "$.x`y.k": ("OBJECT", 1), "$.x`y.k.l": ("VARIANT", 1), "$.f": ("ARRAY", 1), "$.f[]": ("VARIANT", 1), "$.t": ("ARRAY", 1), "$.t[]": ("VARIANT", 1)}


def test_a_document_and_its_schema_text_say_the_same(spark):
    """Where nothing is hidden: counts and offsets of each width, texts of each length."""
    items = [{"n": i, "s": "x" * i, "p": i / 4, "z": None, "t": bool(i % 2)} for i in range(300)]
    texts = [json.dumps(d) for d in (1, None, "x" * 100, {}, {"a": {}}, {"k": items}, {f"k{i}": [i, -i * 10**9] for i in range(300)}, [[{}], [{"o": 1.5}]], {f"k{i}": i for i in range(70000)})]
    df = spark.createDataFrame([(t,) for t in texts], "t string").select(F.parse_json("t").alias("raw"), F.schema_of_variant(F.parse_json("t")).alias("s"))
    for r in df.withColumn("hidden", V._hidden(F.col("s"))).collect():
        said = V._rows(V.paths_in_document(r["raw"].value, V.keys_in_metadata(r["raw"].metadata)))
        assert not r["hidden"] and sorted(map(str, said)) == sorted(map(str, V._rows(V.paths_in_schema(r["s"]))))
