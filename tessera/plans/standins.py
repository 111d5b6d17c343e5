"""Stand-ins: the driver's TPC-H-like tables playing the parts of the insurance model.

orders -> claims and bills, lineitem -> nested claim items and payments, customer -> policies
and masked persons, documents/labels -> fact/dimension with real orphans. Everything here is a
Spark transformation of the given tables, so its work grows with them.
"""

from __future__ import annotations

from functools import lru_cache

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.operators.flatten import DocumentSpec, Field
from tessera.session import work_path
from tessera.sources.readers import list_files

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "labels", "embeddings", "pages", "benchmark", "conversations")

# Documents: largest number of items written into one document. A claim with more items is
# split into several documents (same claim fields, disjoint items), so no document and no
# grouping task has to hold an unbounded item list. The flattened rows do not depend on it.
MAX_ITEMS_PER_DOCUMENT = 1000

# Items that one task groups and sorts into documents, at most about: with more of them than the
# session's shuffle partitions can take, they are dealt over more partitions, so a task's memory does
# not grow with the input (a million took 220 MB; three million were spilled at 6 GB for four tasks).
ITEMS_PER_TASK = 500_000

JSON_OPTIONS = {"timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
                "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"}


def reader(spark: SparkSession, sf_dir: str):
    """name -> DataFrame over ``{sf_dir}/{name}.parquet``."""
    @lru_cache(maxsize=None)
    def table(name: str) -> DataFrame:
        return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
    return table


ORDER_CLAIM_SPEC = DocumentSpec(
    doc_fields=(
        Field("claim_id", "$.claim_id", "bigint"),
        Field("policy_number", "$.policy_number", "bigint"),
        Field("claim_status", "$.status", "string"),
        Field("estimated_damage_usd", "$.estimated_damage_usd", "double"),
        Field("reported_at", "$.reported_at", "timestamp_ntz"),
        Field("incident_type", "$.incident_type", "string"),
    ),
    array_path="$.items",
    item_fields=(
        Field("item_part", "$.part", "bigint"),
        Field("item_supplier", "$.supplier", "bigint"),
        Field("item_line", "$.line", "int"),
        Field("item_quantity", "$.quantity", "double"),
        Field("item_price", "$.price", "double"),
        Field("item_discount", "$.discount", "double"),
        Field("item_tax", "$.tax", "double"),
        Field("item_return_flag", "$.return_flag", "string"),
        Field("item_line_status", "$.line_status", "string"),
        Field("item_shipped_at", "$.shipped_at", "timestamp_ntz"),
    ),
)


def _large_keys(rows: DataFrame, key: str, max_items: int) -> DataFrame:
    """(_key, _n) of the keys with more than ``max_items`` rows: at most one for each ``max_items``
    rows, counted map-side first, so the list is broadcast and the rows are not moved to meet it."""
    return F.broadcast(rows.where(F.col(key).isNotNull()).groupBy(F.col(key).alias("_key")).agg(F.count(F.lit(1)).alias("_n"))
                       .where(F.col("_n") > max_items))


def _dealt(rows: DataFrame, n_rows: int, *keys: str) -> DataFrame:
    """``rows`` dealt out by ``keys``: over the session's shuffle partitions, or over more where these
    would get more than ``ITEMS_PER_TASK`` rows each."""
    needed = -(-n_rows // ITEMS_PER_TASK)
    if needed > int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")):
        return rows.repartition(needed, *keys)
    return rows.repartition(*keys)


def chunked_lists(rows: DataFrame, key: str, item, max_items: int = MAX_ITEMS_PER_DOCUMENT,
                  name: str = "items") -> DataFrame:
    """(key, chunk, list of items): the items of one key spread over ceil(n/max_items) chunks
    by a hash of a per-row id, so no list (and no grouping task) is unbounded. The row id is
    taken right at the scan, so a retried task recomputes the same ids. Rows without a key have
    no list."""
    li = rows.select(key, F.monotonically_increasing_id().alias("_uid"), item.alias("_item"))
    # Only keys with more than max_items items (a short list) are cut. The rows are dealt out by
    # (key, chunk) before the grouping, so the chunks of a hot key run in different tasks: the
    # only time that the rows are moved.
    large = _large_keys(rows, key, max_items)
    chunk = F.pmod(F.xxhash64("_uid"), F.ceil(F.col("_n") / F.lit(max_items)))
    items = (li.where(F.col(key).isNotNull()).join(large, F.col(key) == F.col("_key"), "left")
             .withColumn("_chunk", F.coalesce(chunk, F.lit(0))).select(key, "_chunk", "_item"))
    # Of Parquet files, counting all rows reads only the footers.
    return (_dealt(items, rows.count(), key, "_chunk")
            .groupBy(key, "_chunk").agg(F.collect_list("_item").alias(name)))


def join_lists(parents: DataFrame, parent_key: str, rows: DataFrame, key: str, item,
               max_items: int = MAX_ITEMS_PER_DOCUMENT, name: str = "items") -> DataFrame:
    """``parents`` with each list of their items; one row without a list (NULL) for a parent without
    items. A parent is dealt out to the chunks of its key, so the lists stay where they were made."""
    lists = chunked_lists(rows, key, item, max_items, name)
    chunks = F.sequence(F.lit(0).cast("long"), F.coalesce(F.ceil(F.col("_n") / F.lit(max_items)) - 1, F.lit(0)).cast("long"))
    dealt = (parents.join(_large_keys(rows, key, max_items), F.col(parent_key) == F.col("_key"), "left")
             .select(*parents.columns, F.col("_n").isNotNull().alias("_cut"), F.explode(chunks).alias("_at")))
    joined = dealt.join(lists, (F.col(parent_key) == F.col(key)) & (F.col("_at") == F.col("_chunk")), "left")
    # A chunk that the hash gave nothing is no document.
    return joined.where(~F.col("_cut") | F.col(name).isNotNull()).select(*parents.columns, name)


def claim_documents(orders: DataFrame, lineitem: DataFrame,
                    max_items: int = MAX_ITEMS_PER_DOCUMENT, keep: tuple[str, ...] = ()) -> DataFrame:
    """One JSON text per (claim, item chunk); claims without items get one document with an
    empty array. ``keep``: columns of ``orders`` that go along beside the text."""
    item = F.struct(F.col("l_partkey").alias("part"), F.col("l_suppkey").alias("supplier"),
                    F.col("l_linenumber").alias("line"), F.col("l_quantity").alias("quantity"),
                    F.col("l_extendedprice").alias("price"), F.col("l_discount").alias("discount"),
                    F.col("l_tax").alias("tax"), F.col("l_returnflag").alias("return_flag"),
                    F.col("l_linestatus").alias("line_status"),
                    F.col("l_shipdate").alias("shipped_at"))
    docs = join_lists(orders, "o_orderkey", lineitem, "l_orderkey", item, max_items)
    doc = F.struct(
        F.col("o_orderkey").alias("claim_id"), F.col("o_custkey").alias("policy_number"),
        F.col("o_orderstatus").alias("status"),
        F.col("o_totalprice").alias("estimated_damage_usd"),
        F.col("o_orderdate").alias("reported_at"),
        F.col("o_orderpriority").alias("incident_type"),
        F.coalesce(F.col("items"), F.array().cast(docs.schema["items"].dataType)).alias("items"))
    return docs.select(F.to_json(doc, JSON_OPTIONS).alias("value"), *keep)


def input_version(spark: SparkSession, sf_dir: str) -> tuple:
    """What a staged stand-in is good for: this application, the folder, and its files as they
    are now (names, sizes and times of change), so a changed input is staged anew."""
    files = list_files(spark, sf_dir, "*.parquet")
    seen = files.agg(F.count("*"), F.sum(F.xxhash64("path", "size", "last_modified").cast("decimal(38,0)"))).first()
    return spark.sparkContext.applicationId, sf_dir.rstrip("/"), seen[0], str(seen[1])


_LANDED: dict[tuple, str] = {}


def write_documents(documents: DataFrame, path: str, by: str | None = None) -> None:
    """NDJSON files. They repeat every key in every document, so they are landed compressed (a
    quarter of the bytes at hardly any time) and read back by their extension."""
    writer = documents.write.mode("error").option("compression", "lz4")
    (writer.partitionBy(by) if by else writer).text(path)


def land_claim_documents(spark: SparkSession, sf_dir: str, name: str = "claims-landing") -> str:
    """Write the stand-in claim documents as NDJSON files once per application and input
    folder (the inputs are read-only, so the landing is reused like any landed file set);
    returns the folder."""
    key = (*input_version(spark, sf_dir), name)
    if key not in _LANDED:
        t = reader(spark, sf_dir)
        path = work_path(spark, name)
        write_documents(claim_documents(t("orders"), t("lineitem")), path)
        _LANDED[key] = path
    return _LANDED[key]


# Keys of the driver tables: table -> (primary key, ((fk, parent, parent key), ...)).
KEYS = {
    "region": (("r_regionkey",), ()),
    "nation": (("n_nationkey",), (("n_regionkey", "region", "r_regionkey"),)),
    "customer": (("c_custkey",), (("c_nationkey", "nation", "n_nationkey"),)),
    "supplier": (("s_suppkey",), (("s_nationkey", "nation", "n_nationkey"),)),
    "part": (("p_partkey",), ()),
    "orders": (("o_orderkey",), (("o_custkey", "customer", "c_custkey"),)),
    "lineitem": (("l_orderkey", "l_linenumber"), (("l_orderkey", "orders", "o_orderkey"),
                                                  ("l_partkey", "part", "p_partkey"),
                                                  ("l_suppkey", "supplier", "s_suppkey"))),
    "events": (("event_id",), ()),
    "documents": (("doc_id",), ()),
    "labels": (("doc_id",), (("doc_id", "documents", "doc_id"),)),
    "conversations": (("conv_id", "turn"), ()),
    "pages": (("page_id",), ()),
    "benchmark": (("item_id",), ()),
    "embeddings": (("vec_id",), ()),
}
# Coverage checks in the other direction (parent rows with no child row).
REVERSE = (("claims_without_items", "orders", "o_orderkey", "lineitem", "l_orderkey"),
           ("documents_without_label", "documents", "doc_id", "labels", "doc_id"))


def standin_rules():
    """The rule set over the driver tables (same families as the relational load check)."""
    from tessera.operators import quality as Q

    rules = [Q.pk_not_null(t, pk) for t, (pk, _) in KEYS.items()]
    rules += [Q.unique(t, pk) for t, (pk, _) in KEYS.items()]
    rules += [Q.no_orphans(t, (fk,), parent, (pk,)) for t, (_, fks) in KEYS.items()
              for fk, parent, pk in fks]
    rules += [Q.no_orphans(child, (fk,), parent, (pk,), name=name)
              for name, child, fk, parent, pk in REVERSE]
    rules += [Q.not_empty(t) for t in KEYS]
    rules.append(Q.unique("customer", ("c_name",), name="unique[customer.c_name]"))
    rules.append(Q.max_length("customer", "c_name", 20))
    rules.append(Q.custom("date_order[lineitem]", "lineitem", date_order_offenders,
                          "an item must not ship before its order date",
                          order_by=("l_orderkey", "l_linenumber")))
    rules.append(Q.row_rule("paid_zero_balance[orders]", "orders", paid_predicate,
                            "a fulfilled order must have zero balance",
                            ("o_orderkey", "o_orderstatus", "o_totalprice"),
                            order_by=("o_orderkey",)))
    return rules


def paid_predicate():
    return (F.upper("o_orderstatus") == "F") & (F.coalesce(F.col("o_totalprice"), F.lit(0)) != 0)


def date_order_offenders(t) -> DataFrame:
    """Items shipped before their order date (a cross-table column-order rule)."""
    o = t("orders").select(F.col("o_orderkey").alias("l_orderkey"), "o_orderdate")
    return (t("lineitem").select("l_orderkey", "l_linenumber", "l_shipdate").join(o, "l_orderkey")
            .where(F.col("l_shipdate") < F.col("o_orderdate")))


# Payments stand-in: orders are bills, line items are payments made against them.
PAYMENTS_AS_OF = "1998-08-02"
PAYMENTS_EDITED_AT = "1998-08-02 12:00:00"
PAYMENT_ORDER = ("pay_line", "pay_part", "pay_supplier", "amount", "payment_method")


def bills(t) -> DataFrame:
    o = t("orders")
    return o.select(
        F.col("o_orderkey").alias("id"), F.col("o_custkey").alias("policy_id"),
        F.date_add(F.col("o_orderdate").cast("date"), 30).alias("due_date"),
        F.col("o_totalprice").cast("decimal(10,2)").alias("balance"),
        F.when(F.col("o_orderstatus") == "F", "Paid").when(F.col("o_orderstatus") == "O", "Pending")
        .otherwise("Overdue").alias("status"),
        F.lit(None).cast("string").alias("payment_method"),
        F.col("o_orderdate").alias("created_date"))


def payments(t) -> DataFrame:
    li = t("lineitem")
    method = (F.when(F.col("l_returnflag") == "R", "credit_card")
              .when(F.col("l_returnflag") == "A", "bank_transfer")
              .when(F.col("l_linestatus") == "O", "international_wire_transfer")
              .otherwise("cash"))
    return li.select(
        F.col("l_orderkey").alias("bill_id"), F.col("l_linenumber").alias("pay_line"),
        F.col("l_partkey").alias("pay_part"), F.col("l_suppkey").alias("pay_supplier"),
        F.round(F.col("l_extendedprice").cast("decimal(12,2)")
                * (1 - F.col("l_discount").cast("decimal(4,2)")) - 2000, 2).cast("decimal(10,2)")
        .alias("amount"),
        method.alias("payment_method"),
        F.concat(F.lit("supplier-"), F.col("l_suppkey").cast("string")).alias("edited_by"))


def edit_log(t) -> DataFrame:
    """Existing log: one creation entry per bill, ids 1..n."""
    o = t("orders")
    return o.select((F.col("o_orderkey") + 1).alias("id"), F.col("o_custkey").alias("policy_id"),
                    F.lit("Bill").alias("edited_table_name"), F.col("o_orderdate").alias("edited_date"),
                    F.lit("created").alias("additional_info"), F.lit("seed").alias("edited_by"))


def persons(t) -> DataFrame:
    """Customers as involved persons with a phone and an address derived from their keys."""
    c = t("customer")
    phone = F.concat(F.lit("+57-3"), F.lpad(F.col("c_nationkey").cast("string"), 2, "0"), F.lit("-"),
                     F.expr("lpad(CAST(c_custkey AS STRING), greatest(7, length(CAST(c_custkey AS STRING))), '0')"))
    address = F.concat(F.col("c_mktsegment"), F.lit(" district "), F.col("c_nationkey").cast("string"))
    return c.select("c_custkey", F.col("c_name").alias("party_name"), phone.alias("party_phone"),
                    address.alias("party_address"))


_LANDING_TABLES: dict[tuple, str] = {}


def claim_landing_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The landed claim documents as a Parquet landing table (VARIANT column + lineage),
    written once per application and input folder from the JSON files; analytic queries read
    this instead of parsing JSON again."""
    from tessera.sources.readers import read_json_documents

    key = input_version(spark, sf_dir)
    if key not in _LANDING_TABLES:
        path = work_path(spark, "claims-landing-table")
        read_json_documents(spark, land_claim_documents(spark, sf_dir), outer_array=False) \
            .write.mode("error").parquet(path)
        _LANDING_TABLES[key] = path
    return spark.read.parquet(_LANDING_TABLES[key])


def repair_documents(orders: DataFrame, lineitem: DataFrame,
                     max_items: int = MAX_ITEMS_PER_DOCUMENT) -> DataFrame:
    """Repair-claim documents: nested ``adjuster`` struct whose ``agency`` key is present only
    for urgent claims (NULL fields are left out of the JSON), timestamps with a 'Z' suffix,
    a declared total equal to the sum of all the claim's line costs (repeated on every
    document of a claim split into chunks), and the repair lines."""
    item = F.struct(F.col("l_partkey").alias("part"), F.col("l_returnflag").alias("damage_severity"),
                    F.col("l_quantity").alias("labor_hours"),
                    F.col("l_extendedprice").cast("decimal(12,2)").alias("estimated_cost"))
    totals = lineitem.groupBy(F.col("l_orderkey").alias("_tk")).agg(
        F.sum(F.col("l_extendedprice").cast("decimal(12,2)")).alias("total"))
    d = join_lists(orders.join(totals, orders.o_orderkey == totals._tk, "left").drop("_tk"),
                   "o_orderkey", lineitem, "l_orderkey", item, max_items)
    doc = F.struct(
        F.col("o_orderkey").cast("string").alias("claim_id"),
        F.col("o_custkey").cast("string").alias("policy_number"),
        F.concat(F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss"), F.lit("Z")).alias("reported_at"),
        F.col("o_orderpriority").alias("claim_type"), F.col("o_orderstatus").alias("status"),
        F.struct(F.concat(F.lit("adjuster"), F.col("o_custkey").cast("string"),
                          F.lit("@example.com")).alias("email"),
                 F.when(F.col("o_orderpriority") == "1-URGENT",
                        F.concat(F.lit("AG-"), F.col("o_custkey").cast("string"))).alias("agency"))
        .alias("adjuster"),
        F.coalesce(F.col("total"), F.lit(0).cast("decimal(22,2)")).alias("estimated_total_cost"),
        F.coalesce(F.col("items"), F.array().cast(d.schema["items"].dataType))
        .alias("repair_line_items"))
    return d.select(F.to_json(doc).alias("value"))
