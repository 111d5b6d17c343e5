"""What the staging of documents moves and writes."""

import re

from pyspark.sql import functions as F

from tessera.plans import standins as SI
from tessera.session import work_path
from tessera.sources.readers import list_files, read_json_documents

SF = "/root/testdata/sf0.001"


def exchanges_of(df, column):
    """Shuffles of a plan whose rows carry ``column``."""
    text = df._sc._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")
    moved = re.findall(r"\(\d+\) Exchange\nInput \[\d+\]: \[([^\n]*)\]\nArguments: [^\n]*(?:hash|range)partitioning", text)
    return sum(bool(re.search(rf"\b{column}#", m)) for m in moved)


def test_items_are_moved_once(spark):
    t, threshold = SI.reader(spark, SF), spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        docs = SI.claim_documents(t("orders"), t("lineitem"))
        assert exchanges_of(docs, "_item") + exchanges_of(docs, "items") == 1
        repairs = SI.repair_documents(t("orders"), t("lineitem"))
        assert exchanges_of(repairs, "_item") + exchanges_of(repairs, "items") == 1
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)


def test_tasks_follow_the_items_not_the_setting(spark, monkeypatch):
    """However few the shuffle partitions, no task groups many more than ``ITEMS_PER_TASK`` items."""
    t, most, threshold = SI.reader(spark, SF), 300, spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    lists = SI.chunked_lists(t("lineitem"), "l_orderkey", F.lit(1))
    whole = sorted(r[0] for r in lists.select(F.size("items")).collect())
    monkeypatch.setattr(SI, "ITEMS_PER_TASK", most, raising=False)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        docs = SI.claim_documents(t("orders"), t("lineitem"))
        assert exchanges_of(docs, "_item") + exchanges_of(docs, "items") == 1
        lists = SI.chunked_lists(t("lineitem"), "l_orderkey", F.lit(1))
        assert sorted(r[0] for r in lists.select(F.size("items")).collect()) == whole
        for df, items in (lists, F.size("items")), (docs, F.size(F.split("value", '"part":')) - 1):
            tasks = df.groupBy(F.spark_partition_id()).agg(F.sum(items).alias("items")).collect()
            assert sum(r["items"] for r in tasks) == sum(whole) and max(r["items"] for r in tasks) < 2 * most
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)


def test_landed_documents_are_compressed_and_whole(spark):
    t, plain, path = SI.reader(spark, SF), work_path(spark, "plain"), SI.land_claim_documents(spark, SF)
    SI.claim_documents(t("orders"), t("lineitem")).write.text(plain)

    def size(folder):
        return list_files(spark, folder, "part-*").agg(F.sum("size")).first()[0]

    def raw(folder):
        return sorted(r[0] for r in read_json_documents(spark, folder, outer_array=False).select(
            F.variant_get("raw", "$.claim_id", "string")).collect())
    assert size(path) * 2 < size(plain) and raw(path) == raw(plain)


def test_join_lists_keeps_every_parent_and_item(spark):
    parents = spark.createDataFrame([(1, "a"), (1, "b"), (2, "c"), (None, "d"), (3, "e")], "k int, name string")
    rows = spark.createDataFrame([(1, i) for i in range(7)] + [(3, 9), (None, 8), (None, 7), (4, 6)], "key int, v int")
    for most in (1, 2, 3, 100):
        got = SI.join_lists(parents, "k", rows, "key", F.col("v"), most).collect()
        items = {n: sorted(v for r in got if r["name"] == n for v in r["items"] or []) for n in "abcde"}
        assert items == {"a": list(range(7)), "b": list(range(7)), "c": [], "d": [], "e": [9]}
        assert all(r["items"] for r in got if r["name"] in "abe")  # no empty chunk of a claim with items
        assert [r["items"] for r in got if r["name"] in "cd"] == [None, None]
        assert max(len(r["items"] or []) for r in got) == 7 if most == 100 else len(got) > 5


def test_array_and_run_landings_are_compressed(spark):
    from tessera.plans import catalog, catalog_more

    files = catalog_more._array_landing(spark, SF).inputFiles()
    runs = -(-SI.reader(spark, SF)("orders").count() // catalog_more.ARRAY_CLAIMS)
    assert len(files) == runs and all(f.endswith(".txt.lz4") for f in files)
    root, _ = catalog._two_runs(spark, SF, incremental=True)
    names = [r["name"] for r in list_files(spark, f"{root}/src", "part-*").collect()]
    assert names and all(n.endswith(".txt.lz4") for n in names)
