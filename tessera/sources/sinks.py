"""Sinks: the CSV extract contract and a by-table extract driver.

CSV contract: UTF-8, comma, minimal quoting, header, NULL as empty field, booleans TRUE/FALSE,
ISO dates, timestamps 'YYYY-MM-DD HH:MM:SS' with a fraction only when it is non-zero. Output is
a directory of part files written in parallel by the executors.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def csv_text(c: Column, dtype: T.DataType) -> Column:
    if isinstance(dtype, T.BooleanType):
        return F.when(c, F.lit("TRUE")).when(~c, F.lit("FALSE"))
    if isinstance(dtype, T.StringType):
        return c
    return c.cast("string")


def to_csv_strings(df: DataFrame, column_order: list[str] | None = None) -> DataFrame:
    types = {f.name: f.dataType for f in df.schema.fields}
    order = column_order or df.columns
    return df.select(*[csv_text(F.col(f"`{n}`"), types[n]).alias(n) for n in order])


def write_csv(df: DataFrame, path: str, *, column_order: list[str] | None = None,
              compression: str | None = None, mode: str = "error") -> None:
    writer = (to_csv_strings(df, column_order).write.mode(mode)
              .option("header", True).option("sep", ",").option("quote", '"')
              .option("escape", '"').option("nullValue", "").option("emptyValue", '""')
              .option("quoteAll", False).option("encoding", "UTF-8")
              .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False))
    if compression:
        writer = writer.option("compression", compression)
    writer.csv(path)


def extract_tables(tables: dict[str, DataFrame], out_dir: str, only: str | None = None,
                   compression: str | None = None, parallel: int = 4) -> dict[str, str]:
    """Extract every table (or only one) to ``out_dir/<table>``; returns table -> path.
    ``SELECT *`` semantics, so new source columns flow through. Tables are independent jobs,
    submitted from a small thread pool."""
    from concurrent.futures import ThreadPoolExecutor

    names = [n for n in tables if not only or n == only]

    def one(name: str) -> str:
        path = f"{out_dir}/{name}"
        write_csv(tables[name], path, compression=compression, mode="overwrite")
        return path

    with ThreadPoolExecutor(max_workers=max(1, parallel)) as pool:
        return dict(zip(names, pool.map(one, names)))
