"""Sources: seed JSON, contract CSV, JSON documents as VARIANT, file listings.

Every reader returns a lazy DataFrame; nothing is collected. Text is read as strings and typed
by column *name* (never by position), so column order in a file does not matter.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.sources.contracts import TableContract, lenient_cast, seed_conversion, strict_cast


class ContractError(ValueError):
    """Input does not fit the declared contract (missing columns, bad header)."""


@dataclass(frozen=True)
class CsvContract:
    """Named CSV format: header row parsed as names, comma, optional '"' quoting with doubled
    quotes as escape, empty field -> NULL (quoted empty too), spaces kept, compression by file
    extension. ``multi_line`` allows newlines inside quoted fields; it makes each file a single
    split, so a contract asks for it only where its data holds embedded newlines."""

    delimiter: str = ","
    quote: str = '"'
    escape: str = '"'
    multi_line: bool = False
    encoding: str = "UTF-8"

    def reader(self, spark: SparkSession, mode: str = "FAILFAST"):
        return (spark.read.format("csv")
                .option("header", True)
                .option("sep", self.delimiter)
                .option("quote", self.quote)
                .option("escape", self.escape)
                .option("multiLine", self.multi_line)
                .option("encoding", self.encoding)
                .option("ignoreLeadingWhiteSpace", False)
                .option("ignoreTrailingWhiteSpace", False)
                .option("inferSchema", False)
                # every file's header must match the names (never bind later files by position)
                .option("enforceSchema", False)
                .option("nullValue", "")
                .option("emptyValue", "")
                .option("mode", mode))


DEFAULT_CSV = CsvContract()


def read_csv_strings(spark: SparkSession, path: str, fmt: CsvContract = DEFAULT_CSV,
                     mode: str = "FAILFAST") -> DataFrame:
    """All-string CSV read with header names; ragged rows raise under FAILFAST."""
    return fmt.reader(spark, mode).load(path)


def csv_header(spark: SparkSession, path: str, fmt: CsvContract = DEFAULT_CSV) -> list[str]:
    """Column names of the CSV header (parsed by the CSV parser, so quoted commas are safe).
    Spark checks every file's header against the first when ``enforceSchema`` is off."""
    return fmt.reader(spark).load(path).columns


def _by_name(df: DataFrame) -> dict[str, str]:
    return {c.strip().lower(): c for c in df.columns}


def typed_by_name(df: DataFrame, contract: TableContract, *, allow_missing: bool = False,
                  lenient: bool = False, keep: tuple[str, ...] = ()) -> DataFrame:
    """Match string columns to the contract by case-insensitive name and cast each to its
    declared type. Strict casts raise on bad text (the load aborts); ``lenient`` gives NULL."""
    names = _by_name(df)
    missing = [c.name for c in contract.columns if c.name.lower() not in names]
    if missing and not allow_missing:
        raise ContractError(f"{contract.name}: source lacks columns {sorted(missing)}")
    cast = lenient_cast if lenient else strict_cast
    cols: list[Column] = []
    for spec in contract.columns:
        src = names.get(spec.name.lower())
        c = F.col(f"`{src}`") if src else F.lit(None).cast("string")
        cols.append(cast(spec, c).cast(spec.spark_type).alias(spec.name))
    return df.select(*cols, *[F.col(k) for k in keep])


def read_seed(spark: SparkSession, path: str, contract: TableContract,
              multi_line: bool = True) -> DataFrame:
    """Seed file(s): JSON objects whose values are all strings (a JSON array per file when
    ``multi_line``, else one object per line) -> typed rows by the contract's conversions.
    An array file is one task; large seeds should arrive as several files or as NDJSON."""
    raw = (spark.read.schema(contract.string_struct)
           .option("multiLine", multi_line).option("mode", "FAILFAST").json(path))
    return raw.select(*[seed_conversion(s, F.col(s.name)).alias(s.name)
                        for s in contract.columns])


def read_json_documents(spark: SparkSession, path: str, *, outer_array: bool = True,
                        column: str = "raw", mode: str = "FAILFAST") -> DataFrame:
    """JSON documents landed as one VARIANT per document, with lineage columns.

    ``outer_array``: each file holds a JSON array whose elements are the documents (read whole,
    one task per file, then exploded). Otherwise one document per line (splittable; preferred
    at scale). A malformed file raises (FAILFAST), so a bad batch lands nothing."""
    reader = (spark.read.format("json").option("singleVariantColumn", column)
              .option("mode", mode).option("multiLine", outer_array))
    df = reader.load(path)
    return with_document_lineage(df, column, outer_array)


def with_document_lineage(df: DataFrame, column: str = "raw",
                          outer_array: bool = True) -> DataFrame:
    lineage = [F.col("_metadata.file_name").alias("_source_file"),
               F.col("_metadata.file_path").alias("_source_path")]
    if outer_array:
        df = df.select(*lineage, F.explode(F.variant_get(F.col(column), "$", "array<variant>"))
                       .alias(column))
    else:
        df = df.select(*lineage, F.col(column))
    return df.select(F.col(column), "_source_file", "_source_path",
                     F.current_timestamp().cast("timestamp_ntz").alias("_loaded_at"))


def list_files(spark: SparkSession, path: str, glob: str | None = None) -> DataFrame:
    """Staged files with name, size and modification time (content column is pruned)."""
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", True)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    return reader.load(path).select(
        F.col("path"), F.element_at(F.split("path", "/"), -1).alias("name"),
        F.col("length").alias("size"),
        F.col("modificationTime").cast("timestamp_ntz").alias("last_modified"))


def preview(df: DataFrame, n: int = 3) -> DataFrame:
    """Look at files in place before loading (no order: any n rows)."""
    return df.limit(n)
