"""Failure-safe table replacement on Parquet: write a new version, verify it, then swap.

A plain ``mode("overwrite")`` (or ``INSERT OVERWRITE``) deletes the old files before the new
ones are complete, so a failed job leaves the table empty. Here every load writes
``<root>/<table>/v=<version>`` and only after the write succeeded and its row count (measured
by an ``Observation`` on the write itself, no second scan) was checked is the version
committed in the database's manifest (``plans.manifest``: one file, put in place in one step, for
all tables of a publish) and the catalog table pointed at the new folder (``ALTER TABLE ... SET
LOCATION``, a metadata operation). Readers see the previous version until that moment. Several
tables are published together by writing all versions first and committing them in one manifest.
The manifest decides: a driver lost after the commit leaves catalog tables behind it, and
``recover`` (or the next publish of the table) brings them up.
"""

from __future__ import annotations

import datetime as _dt
import uuid
from urllib.parse import unquote
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tessera.plans.manifest import CommitConflict, Entry, Snapshot, commit, snapshot


class PublishError(RuntimeError):
    pass


@dataclass(frozen=True)
class Version:
    table: str
    path: str
    rows: int


def new_version_id() -> str:
    return _dt.datetime.now(_dt.timezone.utc).strftime("%Y%m%dT%H%M%S") + "-" + uuid.uuid4().hex[:8]


def ensure_database(spark: SparkSession, name: str, root: str) -> None:
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {name} LOCATION '{root}/{name}.db'")


def stage_version(df: DataFrame, table: str, root: str, version: str | None = None,
                  expected_rows: int | None = None, partition_by: tuple[str, ...] = ()) -> Version:
    """Write one new version folder; the written row count comes from the write itself."""
    version = version or new_version_id()
    path = f"{root}/{table.replace('.', '/')}/v={version}"
    obs = Observation(f"rows_{uuid.uuid4().hex[:8]}")
    writer = df.observe(obs, F.count(F.lit(1)).alias("rows")).write.mode("error")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    rows = int(obs.get["rows"])
    if expected_rows is not None and rows != expected_rows:
        raise PublishError(f"{table}: wrote {rows} rows, expected {expected_rows}; not published")
    return Version(table, path, rows)


def _columns(spark: SparkSession, v: Version) -> tuple[dict, dict]:
    """(columns of the catalog table, columns of the version), by lower-case name. The columns of
    the table must all be in the version: a publish never narrows a table."""
    have = ({f.name.lower(): f for f in spark.table(v.table).schema} if spark.catalog.tableExists(v.table) else {})
    want = {f.name.lower(): f for f in spark.read.parquet(v.path).schema}
    lost = sorted(f.name for k, f in have.items() if k not in want)
    if lost:
        raise PublishError(f"{v.table}: the new version lacks column(s) {lost} of the table; not published")
    return have, want


def swap(spark: SparkSession, v: Version) -> None:
    """Point the catalog table at the new version (create it on first publish). New columns are
    added to the table first (they read as NULL until the location changes), then ``SET LOCATION``.
    Only a type change, or a table partitioned in the catalog (its partitions keep their own folders,
    so a new table location would not replace them), replaces the external table definition: the
    old one is renamed, the new one takes its name, and the old name comes back if that fails. In
    between readers of the catalog find no table; readers of the manifest notice nothing, and
    ``recover`` makes the table again should the driver be lost right there."""
    if not spark.catalog.tableExists(v.table):
        spark.sql(f"CREATE TABLE {v.table} USING parquet LOCATION '{v.path}'")
        return
    have, want = _columns(spark, v)
    partitioned = any(c.isPartition for c in spark.catalog.listColumns(v.table))
    if not partitioned and all(have[k].dataType == f.dataType for k, f in want.items() if k in have):
        added = [f for k, f in want.items() if k not in have]
        if added:
            cols = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in added)
            spark.sql(f"ALTER TABLE {v.table} ADD COLUMNS ({cols})")
        spark.sql(f"ALTER TABLE {v.table} SET LOCATION '{v.path}'")
        spark.sql(f"REFRESH TABLE {v.table}")
        return
    tag = uuid.uuid4().hex[:8]
    following, replaced = f"{v.table}__next_{tag}", f"{v.table}{REPLACED}{tag}"
    spark.sql(f"CREATE TABLE {following} USING parquet LOCATION '{v.path}'")
    spark.sql(f"ALTER TABLE {v.table} RENAME TO {replaced}")
    try:
        spark.sql(f"ALTER TABLE {following} RENAME TO {v.table}")
    except Exception:
        spark.sql(f"ALTER TABLE {replaced} RENAME TO {v.table}")
        raise


#: Catalog definitions that a type change left under another name; ``plans.retention`` drops them.
REPLACED = "__replaced_"


def database_of(names) -> str:
    databases = {n.rpartition(".")[0] for n in names}
    if len(databases) != 1 or "" in databases:
        raise PublishError(f"one commit is of the tables of one database, not of {sorted(databases)}")
    return databases.pop()


def entry_of(spark: SparkSession, v: Version, batch: str | None = None) -> Entry:
    return Entry(v.path, v.rows, spark.read.parquet(v.path).schema.json(), batch)


def publish(spark: SparkSession, df: DataFrame, table: str, root: str, *, expected_rows: int | None = None,
            version: str | None = None, base: Snapshot | None = None) -> Version:
    """One table: ``publish_all`` of it alone."""
    base = base or snapshot(spark, root, database_of([table]))
    return publish_versions(spark, [stage_version(df, table, root, version, expected_rows)], root, base)[table]


def _sql_text(v: str) -> str:
    return v.replace("\\", "\\\\").replace("'", "\\'")


def _ddl(df: DataFrame) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields)


def partition_values(spark: SparkSession, table: str, column: str) -> set[str]:
    """Registered values of one partition column (catalog metadata, no data read).
    ``SHOW PARTITIONS`` prints path-escaped values (%XX); they are returned unescaped."""
    if not spark.catalog.tableExists(table):
        return set()
    out = set()
    for r in spark.sql(f"SHOW PARTITIONS {table}").collect():
        for part in r[0].split("/"):
            name, _, value = part.partition("=")
            if name == column:
                out.add(unquote(value))
    return out


def publish_partitions(spark: SparkSession, df: DataFrame, table: str, root: str,
                       column: str, *, version: str | None = None) -> Version:
    """Incremental, failure-safe publish of some partitions of a table partitioned by
    ``column``. The rows are written once to a new version folder; only after that write
    succeeded is each written partition added to the table, or re-pointed when it exists (a
    replayed batch replaces its own rows). Partitions not in ``df`` are untouched, so a run
    costs its new rows, not the whole table. The written values come from an Observation on
    the write (bounded by the number of partitions written)."""
    if spark.catalog.tableExists(table):
        # a partitioned table has one schema: data columns, then the partition column
        have = [(f.name, f.dataType) for f in spark.table(table).schema]
        want = ([(f.name, f.dataType) for f in df.schema if f.name != column]
                + [(column, df.schema[column].dataType)])
        if have != want:
            raise PublishError(f"{table}: new partitions have columns {want}, the table has "
                               f"{have}; rebuild the table in full to change its schema")
    version = version or new_version_id()
    path = f"{root}/{table.replace('.', '/')}/v={version}"
    obs = Observation(f"parts_{uuid.uuid4().hex[:8]}")
    (df.observe(obs, F.count(F.lit(1)).alias("rows"),
                F.collect_set(F.col(column).cast("string")).alias("values"))
     .write.mode("error").partitionBy(column).parquet(path))
    got = obs.get
    if not spark.catalog.tableExists(table):
        spark.sql(f"CREATE TABLE {table} ({_ddl(df)}) USING parquet PARTITIONED BY ({column}) "
                  f"LOCATION '{root}/{table.replace('.', '/')}/base'")
    existing = partition_values(spark, table, column)
    values = sorted(got["values"] or [])

    def spec(v: str) -> str:
        return f"PARTITION (`{column}` = '{_sql_text(v)}')"

    def folder(v: str) -> str:
        # the writer's folder name for the value (path-escaped like Spark's partition folders)
        return f"{path}/{column}={spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.escapePathName(v)}"

    added = [v for v in values if v not in existing]
    if added:
        specs = " ".join(f"{spec(v)} LOCATION '{_sql_text(folder(v))}'" for v in added)
        spark.sql(f"ALTER TABLE {table} ADD IF NOT EXISTS {specs}")
    for v in values:
        if v in existing:
            spark.sql(f"ALTER TABLE {table} {spec(v)} SET LOCATION '{_sql_text(folder(v))}'")
    spark.sql(f"REFRESH TABLE {table}")
    return Version(table, path, int(got["rows"]))


def publish_all(spark: SparkSession, tables: dict[str, DataFrame], root: str, *,
                expected_rows: dict[str, int] | None = None, base: Snapshot | None = None,
                reads: tuple[str, ...] = (), batch: str | None = None) -> dict[str, Version]:
    """All-or-nothing across the tables of a database: every version is written first, then one
    manifest commits them all. A failed write, or a conflict with another commit since ``base``
    (default: the state when the call began), leaves every table on its old version."""
    base = base or snapshot(spark, root, database_of(tables))
    version = new_version_id()
    staged = [stage_version(df, name, root, version, (expected_rows or {}).get(name)) for name, df in tables.items()]
    return publish_versions(spark, staged, root, base, reads=reads, batch=batch)


def publish_versions(spark: SparkSession, staged: list[Version], root: str, base: Snapshot, *,
                     reads: tuple[str, ...] = (), batch: str | None = None) -> dict[str, Version]:
    """Commit written versions together, then let the catalog tables follow. If a catalog call
    fails, a second commit takes the first back (unless somebody has built on it), the tables
    already swapped are pointed back at their previous folders, and tables created by this call
    are dropped, so an error ends in the old state."""
    database_of(v.table for v in staged)
    for v in staged:
        _columns(spark, v)
    previous = {v.table: current_location(spark, v.table) for v in staged}
    done: list[Version] = []
    after = commit(spark, base, {v.table: entry_of(spark, v, batch) for v in staged}, reads)
    try:
        for v in staged:
            swap(spark, v)
            done.append(v)
    except Exception:
        try:
            commit(spark, after, {v.table: base.entry(v.table) for v in staged})
        except CommitConflict:
            raise PublishError(f"{base.database}: committed, but the catalog could not follow; call recover()") from None
        for v in reversed(done):
            loc = previous[v.table]
            if loc is None:
                spark.sql(f"DROP TABLE IF EXISTS {v.table}")
            else:
                swap(spark, Version(v.table, loc, -1))
        raise
    return {v.table: v for v in staged}


def recover(spark: SparkSession, root: str, database: str) -> list[str]:
    """Point every catalog table that is behind its manifest (its writer was lost) at its live
    version, and return their names. Safe to repeat, and to run beside readers of the manifest."""
    behind = []
    for name, e in snapshot(spark, root, database).tables.items():
        table = f"{database}.{name}"
        at = current_location(spark, table)
        if at is None or _plain(at) != _plain(e.path):
            swap(spark, Version(table, e.path, e.rows))
            behind.append(table)
    return sorted(behind)


def _plain(location: str) -> str:
    """A location without the different spellings of a local path."""
    return location.removeprefix("file:").replace("///", "/").rstrip("/")


def current_location(spark: SparkSession, table: str) -> str | None:
    if not spark.catalog.tableExists(table):
        return None
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {table}").where("col_name = 'Location'").collect()
    return rows[0]["data_type"] if rows else None


def table_counts(spark: SparkSession, names: list[str]) -> DataFrame:
    """Presence and row count per table without writing anything; -1 when missing."""
    parts = []
    for n in names:
        if spark.catalog.tableExists(n):
            parts.append(spark.table(n).agg(F.count(F.lit(1)).alias("rows"))
                         .select(F.lit(n).alias("table_name"), F.col("rows")))
        else:
            parts.append(spark.range(1).select(F.lit(n).alias("table_name"),
                                               F.lit(-1).cast("bigint").alias("rows")))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
