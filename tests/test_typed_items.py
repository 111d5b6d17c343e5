"""Items are read as one typed array, with the same rows as a lookup of every path."""

import json

import pytest
from pyspark.sql import functions as F

from tessera.operators.flatten import DocumentSpec, Field, flatten
from tessera.plans import catalog, standins as SI
from tests.conftest import SF

SPEC = DocumentSpec((Field("id", "$.id", "bigint"),), "$.items",
                    (Field("price", "$.price", "double"), Field("at", "$.at", "timestamp_ntz"), Field("name", "$.name", "string"),
                     Field("deep", "$.price.q", "double"), Field("price_text", "$.price", "string")))
ITEMS = [{"price": 17.50, "at": "1996-01-02T00:00:00", "name": 2.50}, {"price": None}, {}, 5, "text", None, [1], {"name": {"q": 1.50}}]


def landed(spark, path, documents):
    spark.createDataFrame([(json.dumps(d),) for d in documents], "j string").select(F.parse_json("j").alias("raw")) \
        .coalesce(1).write.parquet(path)
    return spark.read.parquet(path)


def test_items_come_from_the_columns_of_the_landing(spark, tmp_path):
    rows = flatten(landed(spark, str(tmp_path / "l"), [{"id": i, "items": ITEMS[:1]} for i in range(9)]), SPEC)
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert "array<struct<price:double" in plan and "0:variant" not in plan


@pytest.mark.parametrize("outer", [True, False])
def test_odd_items_are_as_looked_up(spark, tmp_path, outer):
    documents = [{"id": 1, "items": ITEMS}, {"id": 2, "items": []}, {"id": 3, "items": None}, {"id": 4}, {"id": 5, "items": ITEMS[:1]}]
    got = flatten(landed(spark, str(tmp_path / "l"), documents), SPEC, outer=outer).collect()
    first = [(17.5, "1996-01-02 00:00:00", "2.5", "17.5")]
    empty = (None, None, None, None)
    want = [(1, *r) for r in first + [empty] * 6 + [(None, None, '{"q":1.5}', None)]]
    want += [(i, *empty) for i in (2, 3, 4)] * outer + [(5, *first[0])]
    assert sorted(map(str, ((r["id"], r["price"], r["at"] and str(r["at"]), r["name"], r["price_text"]) for r in got))) == sorted(map(str, want))
    assert all(r["deep"] is None for r in got)


def test_a_wrong_type_still_stops_a_strict_flatten(spark, tmp_path):
    land = landed(spark, str(tmp_path / "l"), [{"id": 1, "items": [{"price": 1.5}, {"price": "dear"}]}])
    with pytest.raises(Exception, match="INVALID_VARIANT_CAST"):
        flatten(land, SPEC).collect()
    assert [r["price"] for r in flatten(land, SPEC, strict=False).orderBy(F.col("price").desc()).collect()] == [1.5, None]


def test_documents_of_both_runs_are_made_once(spark, monkeypatch):
    made, one = [], SI.claim_documents
    monkeypatch.setattr(SI, "claim_documents", lambda *a, **k: made.append(1) or one(*a, **k))
    rows = {r["batch_id"]: r["claims"] for r in catalog.landing_batches(spark, SF).collect()}
    orders = spark.read.parquet(f"{SF}/orders.parquet").groupBy(F.year("o_orderdate").alias("y")).count().orderBy("y").collect()
    assert rows == {0: sum(r["count"] for r in orders[:-1]), 1: orders[-1]["count"]}
    assert len(made) == 1
