"""The paths of schema-on-read documents, their types, and how both change from batch to batch.

``paths`` lists the paths of every document of a VARIANT column: the keys of an object, and ``[]`` for
the elements of an array. ``profile`` counts, for each batch and path, the documents that have it and
the types seen there. Types form a lattice: VOID (a JSON null) is below
every type, BIGINT below DECIMAL below DOUBLE, and anything else together is VARIANT; the type of a
path is the least one above all that were seen, so profiles of parts of a batch merge. ``drift``
compares each batch with the one before: paths that are new, gone, or of another type, and the share
of documents that has them.

A document's paths are listed and made distinct within its own row, so what is moved are counts per
task of (batch, path, type), however many documents and elements there are. They are read off the text
of ``schema_of_variant``, each different text once per Arrow batch. That text merges the elements of
an array; where this could hide what they were (``_hidden``) the document itself is walked.
"""

from __future__ import annotations

import re
import struct
import sys
from functools import reduce
from itertools import repeat

import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Python workers get these functions with the job: they need not find this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Number types, lowest first.
NUMBERS = ("BIGINT", "DECIMAL", "DOUBLE")
#: Of an array, in a schema text: types that may come of merging others, and elements that are all null, or none.
_MERGED = ("VARIANT", "DOUBLE", "FLOAT", "TIMESTAMP", "ARRAY<VOID>")
_KIND = re.compile(r"([A-Z_ ]+)(?:\(\d+,\d+\))?<?")
_NAME = re.compile(r"(?:, )?(?:`((?:[^`]|``)*)`|([^`:]+)): ")
#: Of the binary encoding; a UUID is a STRING to Spark.
_PRIMITIVES = {0: "VOID", 1: "BOOLEAN", 2: "BOOLEAN", 3: "BIGINT", 4: "BIGINT", 5: "BIGINT", 6: "BIGINT", 7: "DOUBLE", 8: "DECIMAL", 9: "DECIMAL",
               10: "DECIMAL", 11: "DATE", 12: "TIMESTAMP", 13: "TIMESTAMP_NTZ", 14: "FLOAT", 15: "BINARY", 16: "STRING", 20: "STRING"}
#: By a value's first byte.
_TYPES = {info << 2: t for info, t in _PRIMITIVES.items()} | {h: ("STRING", "OBJECT", "ARRAY")[(h & 3) - 1] for h in range(256) if h & 3}
ADDED, GONE, WIDENED, NARROWED, CHANGED = "added", "gone", "widened", "narrowed", "changed"


def least_above(types: Column) -> Column:
    """The least type above an array of types."""
    said = F.array_except(types, F.array(F.lit("VOID")))
    numbers = F.array(*[F.lit(n) for n in NUMBERS])
    highest = F.element_at(F.array_intersect(numbers, said), -1)
    return (F.when(F.size(said) == 0, F.lit("VOID")).when(F.size(said) == 1, F.element_at(said, 1))
            .when(F.size(F.array_except(said, numbers)) == 0, highest).otherwise(F.lit("VARIANT")))


def _merged(types: set[str]) -> str:
    """``least_above`` of the types of one document at a path."""
    said = types - {"VOID"} or {"VOID"}
    if len(said) == 1:
        return min(said)
    return max(said, key=NUMBERS.index) if said <= set(NUMBERS) else "VARIANT"


def _hidden(schema: Column) -> Column:
    """Whether a schema text may say less of the elements of an array than there is to say."""
    inner = F.substr(schema, F.instr(schema, "ARRAY<"))
    told = [F.contains(inner, F.lit(t)) for t in _MERGED]
    return F.contains(schema, F.lit("ARRAY<")) & reduce(Column.__or__, told)


def paths_in_schema(schema: str) -> set[tuple[str, str]]:
    """(path, type) of a text of ``schema_of_variant``."""
    said, open_, path, at = set(), [], "$", 0
    while True:
        kind = _KIND.match(schema, at)
        said.add((path, kind[1]))
        at = kind.end()
        if kind[1] == "ARRAY":
            open_.append(path)
            path += "[]"
            continue
        if kind[1] == "OBJECT":
            open_.append(path)
        while open_ and schema[at] == ">":
            open_.pop()
            at += 1
        if not open_:
            return said
        name = _NAME.match(schema, at)
        path = f"{open_[-1]}.{name[2] or name[1].replace('``', '`')}"
        at = name.end()


def _numbers(of: bytes, at: int, n: int, size: int):
    """``n`` little-endian numbers of ``size`` bytes."""
    if size == 1:
        return of[at:at + n]
    if size == 3:
        return [int.from_bytes(of[i:i + 3], "little") for i in range(at, at + 3 * n, 3)]
    return struct.unpack_from(f"<{n}{'H' if size == 2 else 'I'}", of, at)


def keys_in_metadata(metadata: bytes) -> list[str]:
    """The keys of a document in the binary encoding of VARIANT, by number."""
    size = (metadata[0] >> 6) + 1
    n = int.from_bytes(metadata[1:1 + size], "little")
    texts = 1 + size * (n + 2)
    ends = [texts + e for e in _numbers(metadata, 1 + size, n + 1, size)]
    return [metadata[b:e].decode() for b, e in zip(ends, ends[1:])]


def paths_in_document(value: bytes, keys: list[str]) -> set[tuple[str, str]]:
    """(path, type) of a document in the binary encoding of VARIANT, all types of a path."""
    said, left = {("$", _TYPES[value[0]])}, [(0, "$")] if value[0] & 2 else []
    while left:
        at, path = left.pop()
        is_array, info = value[at] & 1, value[at] >> 2
        # Header: bytes of a count, of an offset and, of objects, of a key's number.
        size, wide = (info & 3) + 1, 4 if info & (4 if is_array else 16) else 1
        n, offsets = int.from_bytes(value[at + 1:at + 1 + wide], "little"), at + 1 + wide
        if is_array:
            below = repeat(f"{path}[]")
        else:
            key = (info >> 2 & 3) + 1
            below = [f"{path}.{keys[k]}" for k in _numbers(value, offsets, n, key)]
            offsets += n * key
        data = offsets + (n + 1) * size
        for offset, inner in zip(_numbers(value, offsets, n, size), below):
            header = value[data + offset]
            said.add((inner, _TYPES[header]))
            if header & 2:
                left.append((data + offset, inner))
    return said


def _rows(said: set[tuple[str, str]] | frozenset[tuple[str, str]]) -> list[dict]:
    """A row for each path, with the type of the document there."""
    types: dict[str, set[str]] = {}
    for path, type_ in said:
        types.setdefault(path, set()).add(type_)
    return [{"path": p, "type": _merged(t)} for p, t in types.items()]


def _said(schema: pa.Array, hidden: pa.Array) -> pa.Array:
    """The rows of each document, by its schema text or, where given, by the document itself."""
    texts = pc.dictionary_encode(schema)
    walked = hidden.is_valid()
    # Texts of documents that are walked are not read.
    read = set(pc.unique(texts.indices.filter(pc.invert(walked))).to_pylist())
    lists = [_rows(paths_in_schema(t)) if i in read else [] for i, t in enumerate(texts.dictionary.to_pylist())]
    keys: dict[bytes, list[str]] = {}
    places: dict[frozenset, int] = {}
    at = []
    for d in hidden.filter(walked).to_pylist():
        value, metadata = d["value"], d["metadata"]
        if metadata not in keys:
            keys[metadata] = keys_in_metadata(metadata)
        at.append(places.setdefault(frozenset(paths_in_document(value, keys[metadata])), len(lists) + len(places)))
    at = pc.replace_with_mask(texts.indices, walked, pa.array(at, texts.indices.type))
    lists += [_rows(said) for said in places]
    return pa.array(lists, pa.list_(pa.struct([("path", pa.string()), ("type", pa.string())]))).take(at)


def paths(documents: DataFrame, column: str, batch: str) -> DataFrame:
    """(``batch``, ``path``, ``type``): a row for each document and path, with the least type above those
    that the document has there. Documents are read once, however deep they are."""
    df = documents.filter(F.col(column).isNotNull()).select(F.col(batch).alias("batch"), F.col(column).alias("_raw"), F.schema_of_variant(column).alias("_schema"))
    rows = F.arrow_udf(_said, "array<struct<path: string, type: string>>")
    said = df.select("batch", rows("_schema", F.when(_hidden(F.col("_schema")), F.col("_raw"))).alias("said"))
    # No list is empty. Of a plain inline Spark filters the lists first, and makes each of them twice for that.
    return said.select("batch", F.inline_outer("said"))


def profile(documents: DataFrame, column: str = "raw", batch: str = "batch_id") -> DataFrame:
    """``batch``, ``path``, ``type``, ``docs`` (documents that have the path), ``share`` of the batch."""
    counts = paths(documents, column, batch).groupBy("batch", "path", "type").agg(F.count("*").alias("n"))
    # The types at a path are few: they are merged as sets.
    out = counts.groupBy("batch", "path").agg(F.sum("n").alias("docs"), least_above(F.collect_set("type")).alias("type")).filter("docs > 0")
    # Documents are read once for both: the filters, which every row passes, keep Spark from dropping the counts on one side
    # when they are not asked for, and so from counting twice; one for '$' would be pushed below the counts.
    total = out.groupBy("batch").agg(F.max(F.when(F.col("path") == "$", F.col("docs"))).alias("_all")).filter("_all > 0")
    return out.join(total, "batch").select("batch", "path", "type", "docs", (F.col("docs") / F.col("_all")).alias("share"))


def drift(profiles: DataFrame) -> DataFrame:
    """(``batch``, ``path``, ``kind``, ``old_type``, ``new_type``, ``old_share``, ``new_share``): what
    changed against the batch before, of paths that are new, gone or of another type. The profiles
    have a row for each batch and path, which is what this is in proportion to."""
    order = profiles.select("batch").distinct().withColumn("at", F.row_number().over(Window.orderBy("batch")))
    placed = profiles.join(order, "batch")
    new = placed.select("at", "batch", "path", F.col("type").alias("new_type"), F.col("share").alias("new_share"))
    old = placed.select((F.col("at") + 1).alias("at"), "path", F.col("type").alias("old_type"), F.col("share").alias("old_share"))
    both = new.join(old, ["at", "path"], "full").drop("batch").join(order, "at").filter("at > 1")
    up = least_above(F.array("old_type", "new_type"))
    kind = (F.when(F.col("old_type").isNull(), ADDED).when(F.col("new_type").isNull(), GONE)
            .when(up == F.col("new_type"), WIDENED).when(up == F.col("old_type"), NARROWED).otherwise(CHANGED))
    return both.filter("NOT old_type <=> new_type").select("batch", "path", kind.alias("kind"), "old_type", "new_type", "old_share", "new_share")
