"""Contract-driven load of CSV extracts into RAW tables, one table at a time.

``load_table`` never raises; it returns a ``LoadResult`` and writes audit rows for the four
failure exits of a load: missing source, schema drift, load error, nothing processed.

Per table: header read -> drift check against the target -> all-string read (FAILFAST) ->
typed select by column name -> new version written (row count observed on the write) ->
catalog swap -> audit rows per source file. Any error before the swap leaves the previous
version readable.

``on_error="abort"`` (default): one bad row aborts the table. ``on_error="continue"``: rows
that do not convert go to a rejects folder with the line, column, raw value and reason; the rest
loads and the files with rejects are audited as PARTIALLY_LOADED with their first error by position.
The rows are numbered where they are read: a task knows the place of a row in its byte range, and the
rows of the ranges before it in the same file (one count for each range) are added. A line is a
record of the file, the header being line 1; blank lines are not records.
"""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.operators.drift import SchemaDriftError, check_drift, table_columns
from tessera.plans import audit as A
from tessera.plans.manifest import snapshot
from tessera.plans.publish import ensure_database, publish_versions, stage_version
from tessera.session import error_text, work_path
from tessera.sources.contracts import ColumnSpec, TableContract
from tessera.sources.readers import DEFAULT_CSV, CsvContract, csv_header, typed_by_name

LINEAGE = "_source_file"
CORRUPT = "_corrupt_record"
#: Where a row was read: file, byte range, and a number that ascends within the range.
PLACE = ("_path", "_block", "_at")


@dataclass(frozen=True)
class LoadResult:
    table: str
    ok: bool
    status: str
    rows: int
    error: str | None = None
    version: str | None = None
    rejects: int = 0


def _length_guard(df: DataFrame, contract: TableContract) -> DataFrame:
    """VARCHAR(n) columns: longer text aborts the load (as a length-limited column would)."""
    cols = []
    for c in df.columns:
        spec = next((s for s in contract.columns if s.name == c), None)
        if spec is not None and spec.max_length:
            cols.append(F.when(F.length(c) > spec.max_length, F.raise_error(F.format_string(
                f"value too long for {contract.name}.{c} (max {spec.max_length}): %s", F.col(c))))
                .otherwise(F.col(c)).alias(c))
        else:
            cols.append(F.col(c))
    return df.select(*cols)


def with_added_columns(spark: SparkSession, contract: TableContract, table: str) -> TableContract:
    """The contract plus the columns that were added to the table since (after a drift repair):
    they are loaded by name with the table's type, and are NULL when a source lacks them."""
    if not spark.catalog.tableExists(table):
        return contract
    known = {c.lower() for c in contract.column_names} | {LINEAGE}
    added = tuple(ColumnSpec(f.name, "text" if isinstance(f.dataType, T.StringType) else "added",
                             type_=f.dataType.simpleString())
                  for f in spark.table(table).schema if f.name.lower() not in known)
    return replace(contract, columns=contract.columns + added)


def _rejects_of(raw: DataFrame, contract: TableContract, names: dict[str, str]) -> tuple[Column, Column]:
    """(reason, column) of the first field of a row that does not convert; NULL when fine."""
    reason, column = F.lit(None).cast("string"), F.lit(None).cast("string")
    for spec in reversed(contract.columns):
        src = names.get(spec.name.lower())
        if src is None:
            continue
        v = F.col(f"`{src}`")
        if spec.kind in ("text",):
            continue
        if spec.max_length:
            bad = F.length(v) > spec.max_length
            why = F.lit(f"longer than {spec.max_length} characters")
        else:
            bad = v.isNotNull() & v.try_cast(spec.spark_type).isNull()
            why = F.format_string(f"cannot convert '%s' to {spec.spark_type}", v)
        reason = F.when(bad, why).otherwise(reason)
        column = F.when(bad, F.lit(spec.name)).otherwise(column)
    if CORRUPT in raw.columns:  # a ragged / unparseable line wins over field checks
        bad_line = F.col(CORRUPT).isNotNull()
        reason = F.when(bad_line, F.lit("malformed CSV row")).otherwise(reason)
        column = F.when(bad_line, F.lit(None).cast("string")).otherwise(column)
    return reason, column


def with_place(raw: DataFrame) -> DataFrame:
    return raw.select("*", F.col("_metadata.file_path").alias(PLACE[0]), F.col("_metadata.file_block_start").alias(PLACE[1]),
                      F.monotonically_increasing_id().alias(PLACE[2]))


def with_line(rows: DataFrame, all_rows: DataFrame) -> DataFrame:
    """``rows`` with their ``line`` in the file. ``all_rows`` are all rows read, staged with their
    places, so that both sides speak of the same read. The counts, one for each byte range, are
    summed up within each file."""
    path, block, at = PLACE
    ranges = all_rows.groupBy(path, block).agg(F.count("*").alias("_n"), F.min(at).alias("_first"))
    before = F.sum("_n").over(Window.partitionBy(path).orderBy(block).rowsBetween(Window.unboundedPreceding, -1))
    ranges = ranges.select(path, block, "_first", F.coalesce(before, F.lit(0)).alias("_before"))
    return rows.join(ranges, [path, block]).withColumn("line", F.col("_before") + F.col(at) - F.col("_first") + 2).drop("_before", "_first")


def load_table(spark: SparkSession, contract: TableContract, source_path: str, root: str, *,
               schema: str = "raw", on_error: str = "abort", fmt: CsvContract | None = None,
               allow_missing: bool = False, expected_rows: int | None = None) -> LoadResult:
    """Load one table. ``fmt`` defaults to the contract's option ``csv``, then to the plain CSV
    contract (one line per row, so files are split)."""
    table = f"{schema}.{contract.name}"
    file_label = f"{contract.name}.csv"
    fmt = fmt or contract.options.get("csv", DEFAULT_CSV)
    # 1. source present?
    try:
        ensure_database(spark, schema, root)
        base = snapshot(spark, root, schema)  # two loads of one table: the second to commit is refused
        header = csv_header(spark, source_path, fmt)
    except Exception as e:  # noqa: BLE001 - every load error is reported, never raised
        msg = error_text(e)
        kind = "missing source" if "PATH_NOT_FOUND" in msg else "no files processed"
        A.record(spark, root, [(contract.name, None, 0, A.LOAD_FAILED, f"{kind}: {msg}")])
        return LoadResult(table, False, A.LOAD_FAILED, 0, f"{kind}: {msg}")
    # 2. drift, before anything is written
    try:
        target = table_columns(spark, table)
        declared, contract = contract, with_added_columns(spark, contract, table)
        added = {c.name for c in contract.columns} - {c.name for c in declared.columns}
        check_drift(contract.name, header, target or contract.column_names, schema,
                    allow_missing=allow_missing)
    except Exception as e:  # noqa: BLE001 - drift, or a table that cannot be read
        if not isinstance(e, SchemaDriftError):
            msg = error_text(e)
            A.record(spark, root, [(contract.name, file_label, 0, A.LOAD_FAILED, msg)])
            return LoadResult(table, False, A.LOAD_FAILED, 0, msg)
        A.record(spark, root, [(contract.name, file_label, 0, A.LOAD_FAILED, str(e))])
        return LoadResult(table, False, A.LOAD_FAILED, 0, str(e))
    # 3. read strings, type by name, write a new version, swap
    try:
        if on_error == "continue":
            # All-string schema from the header names plus the corrupt-record column: ragged
            # lines are kept and flagged instead of failing the read. Headers are still checked
            # by name in every file.
            strings = T.StructType([T.StructField(h, T.StringType()) for h in header]
                                   + [T.StructField(CORRUPT, T.StringType())])
            raw = (fmt.reader(spark, "PERMISSIVE").schema(strings)
                   .option("columnNameOfCorruptRecord", CORRUPT).load(source_path))
        else:
            raw = fmt.reader(spark, "FAILFAST").load(source_path)
        raw = raw.withColumn(LINEAGE, F.col("_metadata.file_name"))
        own = [c for c in raw.columns if c not in (LINEAGE, CORRUPT)]
        names = {c.strip().lower(): c for c in raw.columns if c != CORRUPT}
        for name in sorted(added):  # a source without an added column loads it as NULL
            if name.lower() not in names and allow_missing:
                raw = raw.withColumn(name, F.lit(None).cast("string"))
        if on_error == "continue":
            reason, column = _rejects_of(raw, contract, names)
            place = work_path(spark, "marked")
            with_place(raw.withColumn("_reason", reason).withColumn("_column", column)).write.parquet(place)
            marked = spark.read.parquet(place)
            good = typed_by_name(marked.where(F.col("_reason").isNull()), contract,
                                 allow_missing=allow_missing, keep=(LINEAGE,))
            bad = with_line(marked.where(F.col("_reason").isNotNull()), marked).select(
                F.coalesce(F.col(CORRUPT), F.to_json(F.struct(*[F.col(f"`{c}`") for c in own])))
                .alias("raw"), F.col("_column").alias("column"), F.col(LINEAGE).alias("file"),
                F.col("_reason").alias("reason"), "line")
            rej = stage_version(bad, f"{schema}.{contract.name}__rejects", root)
        else:
            good = _length_guard(typed_by_name(raw, contract, allow_missing=allow_missing,
                                               keep=(LINEAGE,)), contract)
            rej = None
        v = stage_version(good, table, root, expected_rows=expected_rows)
        publish_versions(spark, [v], root, base)
        _audit_files(spark, root, contract.name, v, rej, file_label)
    except Exception as e:  # noqa: BLE001 - every load error is reported, never raised
        msg = error_text(e)
        A.record(spark, root, [(contract.name, f"{file_label}.gz" if source_path.endswith(".gz")
                                else file_label, 0, A.LOAD_FAILED, msg)])
        return LoadResult(table, False, A.LOAD_FAILED, 0, msg)
    n_rej = rej.rows if rej else 0
    status = A.PARTIALLY_LOADED if n_rej else A.LOADED
    return LoadResult(table, True, status, v.rows, None, v.path, n_rej)


def _audit_files(spark: SparkSession, root: str, name: str, v, rej, file_label: str) -> None:
    """One audit row per source file: rows loaded from the version's lineage column, rows
    rejected from the rejects version; computed and appended by Spark."""
    if v.rows == 0 and not (rej and rej.rows):  # header-only source: one row for the table
        A.record(spark, root, [(name, file_label, 0, A.LOADED, None)])
        return
    loaded = (spark.read.parquet(v.path).groupBy(F.col(LINEAGE).alias("file"))
              .agg(F.count(F.lit(1)).alias("rows")))
    if rej and rej.rows:
        rejected = (spark.read.parquet(rej.path).groupBy("file")
                    .agg(F.count(F.lit(1)).alias("rejected"),
                         F.min_by(F.format_string("line %d: %s", F.col("line"), F.concat_ws(": ", "column", "reason")),
                                  "line").alias("first_error")))
        per_file = loaded.join(rejected, "file", "full")
    else:
        per_file = (loaded.withColumn("rejected", F.lit(None).cast("bigint"))
                    .withColumn("first_error", F.lit(None).cast("string")))
    partial = F.coalesce(F.col("rejected"), F.lit(0)) > 0
    A.record_frame(root, per_file.select(
        F.lit(name).alias("table_name"), "file", F.coalesce(F.col("rows"), F.lit(0)).alias("rows"),
        F.when(partial, F.lit(A.PARTIALLY_LOADED)).otherwise(F.lit(A.LOADED)).alias("status"),
        F.when(partial, F.format_string("%d row(s) rejected; first error: %s", F.col("rejected"),
                                        F.col("first_error"))).alias("error")))


def load_all(spark: SparkSession, contracts: dict[str, TableContract], sources: dict[str, str],
             root: str, *, only: str | None = None, parallel: int = 4,
             schema: str = "raw", **kw) -> DataFrame:
    """Load every table (or one); returns one result row per table. Tables are independent
    Spark jobs submitted from a small thread pool, so small tables overlap instead of queueing.
    A failed table does not stop the others; ``raise_if_failed`` turns failures into an error."""
    from concurrent.futures import ThreadPoolExecutor

    ensure_database(spark, schema, root)
    names = [n for n in contracts if not only or n == only]

    def one(name: str) -> LoadResult:
        path = sources.get(name)
        if path is None:
            A.record(spark, root, [(name, None, 0, A.LOAD_FAILED, "missing source")])
            return LoadResult(f"{schema}.{name}", False, A.LOAD_FAILED, 0, "missing source")
        return load_table(spark, contracts[name], path, root, schema=schema, **kw)

    with ThreadPoolExecutor(max_workers=max(1, parallel)) as pool:
        results = list(pool.map(one, names))
    return spark.createDataFrame(
        [(r.table, r.ok, r.status, r.rows, r.rejects, r.error) for r in results],
        "table_name string, ok boolean, status string, rows bigint, rejects bigint, error string")


class LoadFailed(RuntimeError):
    pass


def raise_if_failed(results: DataFrame) -> None:
    bad = [r["table_name"] for r in results.where(~F.col("ok")).collect()]
    if bad:
        raise LoadFailed(f"{len(bad)} table(s) failed to load: {', '.join(bad)}")
