"""Stand-in builders and the driver contract on the smallest driver tables."""

from pyspark.sql import functions as F

import __spark_entry__ as E
from tessera.operators import claims as C
from tessera.operators.flatten import flatten, reconcile
from tessera.plans import standins as SI
from tessera.session import work_path
from tessera.sources.readers import read_json_documents

SF = "/root/testdata/sf0.001"


def test_chunked_documents_give_the_same_flatten(spark):
    t = SI.reader(spark, SF)
    path = work_path(spark, "chunks")
    SI.claim_documents(t("orders"), t("lineitem"), max_items=2).write.text(path)
    landing = read_json_documents(spark, path, outer_array=False)
    n_docs = landing.count()
    n_orders = t("orders").count()
    assert n_docs > n_orders  # claims were split over several documents
    staged = flatten(landing, SI.ORDER_CLAIM_SPEC, outer=True)
    expected = t("orders").join(t("lineitem"), t("orders").o_orderkey == t("lineitem").l_orderkey,
                                "left").count()
    assert staged.count() == expected
    r = reconcile(landing, staged, SI.ORDER_CLAIM_SPEC, "claim_id").first()
    assert r["ok"] and r["claims"] == n_orders and r["documents"] == n_docs
    pol = t("customer").select(F.col("c_custkey").alias("policy_number"))
    chunked = sorted(C.claims_by_policy(staged, pol).collect())
    whole = sorted(E.queries()["claims_by_policy"](spark, SF).drop("policy_name").collect())
    assert chunked == whole


def test_entry_and_registry(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert df.columns == ["policy_number", "policy_name", "claims", "damage_usd"]
    q, o = E.queries(), E.oracle_sql()
    assert set(o) <= set(q)
    assert len(q) >= 50
