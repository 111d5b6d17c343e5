"""All rules of a set of tables in one pass: a scan per table and one shuffle.

Every row is turned into a few small *marks* and the marks of all tables are counted together:

* a row rule marks the rows that offend it, an emptiness rule marks every row of its table; these
  marks have no key, so a task hands on one count for each rule;
* a uniqueness rule marks every row with its key;
* the columns that share a *key domain* (a parent key, every foreign key that points to it, and the
  relations checked the other way round) mark their rows with the key and the side they come from.

One ``groupBy(domain, key)`` then holds, for every key, how often each side has it. From these
counts come duplicates (a key twice on one side), orphans (on a child's side and not on the parent's)
and parents without children, whatever number of relations a domain has. A hot key is one row for
each task before the shuffle.

``findings`` are the offending keys and marks (rule, number, order, text); ``counts`` adds them up.
``detail`` also shows the first offenders of each rule. Of an orphan rule these are the smallest
offending keys, each with its smallest child row; of a uniqueness rule, keys and how often they occur; of a row
rule, its first rows. The offending keys are staged with their counts; where the order of the samples
is that of the keys (integers), the first keys of each rule are taken from there and one more job over
the tables of the failed rules keeps the marks of these few keys only. Of other rules it hands on at most
``SAMPLE_ROWS`` rows for each rule and task (a grouped limit before the shuffle). Rules of any other
form keep their own counting job.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.session import work_path

Tables = Callable[[str], DataFrame]
SAMPLE_ROWS = 3
_INTEGERS = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)


def sortable(c: Column, kind: T.DataType) -> Column:
    """A text that orders like the value: integers by a fixed number of digits, counted from the
    smallest long; dates, times and texts as they are. NULL first."""
    if isinstance(kind, _INTEGERS):
        text = F.lpad((c.cast("decimal(20,0)") + F.lit("9223372036854775808").cast("decimal(20,0)")).cast("string"), 20, "0")
    else:
        text = c.cast("string")
    return F.coalesce(F.concat(F.lit("1"), text), F.lit("0"))


def row_text(columns) -> Column:
    """``(a, b, NULL)``: the values of some columns as one text."""
    return F.concat(F.lit("("), F.concat_ws(", ", *[F.coalesce(F.col(c).cast("string"), F.lit("NULL")) for c in columns]), F.lit(")"))


def order_text(df: DataFrame, columns) -> Column:
    return F.concat_ws("\x01", *[sortable(F.col(c), df.schema[c].dataType) for c in columns])


def _key(columns, kinds) -> tuple[Column, Column]:
    """(key as a long, key as a text): one of them is used, by the domain's types."""
    if len(columns) == 1 and isinstance(kinds[0], T.LongType):
        return F.col(columns[0]).cast("long"), F.lit(None).cast("string")
    parts = [F.col(c).cast(k).cast("string") for c, k in zip(columns, kinds)]
    if len(parts) > 1 and _integers(kinds):
        return F.lit(None).cast("long"), F.concat_ws(",", *[F.coalesce(p, F.lit("~")) for p in parts])
    if len(parts) == 1:
        return F.lit(None).cast("long"), parts[0]
    return F.lit(None).cast("long"), F.concat(*[F.coalesce(F.concat(F.length(p), F.lit(":"), p), F.lit("~")) for p in parts])


def _integers(kinds) -> bool:
    return all(isinstance(k, T.LongType) for k in kinds)


def _key_order() -> list[Column]:
    """The order of integer keys (``num``, ``txt``), as that of their ``order_text``."""
    parts = F.transform(F.split("txt", ","), lambda p: sortable(F.nullif(p, F.lit("~")).cast("long"), T.LongType()))
    return [F.col("num").asc_nulls_first(), F.array_join(parts, "\x01")]


def _all_known(columns) -> Column:
    out = F.lit(True)
    for c in columns:
        out = out & F.col(c).isNotNull()
    return out


def _common(a: T.DataType, b: T.DataType, spark: SparkSession) -> T.DataType:
    """The type in which two key columns are compared."""
    if isinstance(a, _INTEGERS) and isinstance(b, _INTEGERS):
        return T.LongType()
    if a == b:
        return a
    both = F.coalesce(F.lit(None).cast(a), F.lit(None).cast(b))
    return spark.range(0).select(both.alias("x")).schema["x"].dataType


class Plan:
    """Which marks each table makes, and where a rule finds its counts. A *side* is one table's key
    columns in a domain; a composite foreign key is a side of its own that leaves out rows with a
    NULL part (no relation), as a uniqueness rule counts those."""

    def __init__(self, tables: Tables, rules, names: dict[str, tuple] | None = None):
        self.tables, self.names = tables, names or {}
        # references first: a key that others point to is marked once, in their domain
        self.rules = sorted(rules, key=lambda r: r.reference is None)
        self.spark = tables(self.rules[0].table).sparkSession
        self.marks: dict[str, list[tuple]] = {}
        self.sides: list[dict[tuple, int]] = []
        self.kinds: list[list[T.DataType]] = []
        self.at: list[tuple | None] = []
        self.shown: set[tuple] = set()  # sides whose rows a sample shows
        for n, r in enumerate(self.rules):
            if r.reference:
                fk, parent, pk = r.reference
                child, parent = (r.table, tuple(fk), len(fk) > 1), (parent, tuple(pk), False)
                d = self._domain([parent, child], parent)
                self.at.append((d, self._side(d, child), self._side(d, parent)))
                self.shown.add((d, child))
            elif r.keys:
                own = (r.table, tuple(r.keys), False)
                d = self._domain([own], own)
                self.at.append((d, self._side(d, own)))
                self.shown.add((d, own))
            else:
                self.marks.setdefault(r.table, []).append(("rule", n))
                self.at.append(None)

    def _types(self, side: tuple) -> list[T.DataType]:
        found = [self.tables(side[0]).schema[c].dataType for c in side[1]]
        return [T.LongType() if isinstance(k, _INTEGERS) else k for k in found]

    def _domain(self, wanted: list[tuple], first: tuple) -> int:
        """The domain that knows one of these sides, or a new one."""
        known = next((d for side in wanted for d, sides in enumerate(self.sides) if side in sides), None)
        if known is None:
            self.sides.append({})
            self.kinds.append(self._types(first))
            known = len(self.sides) - 1
        return known

    def _side(self, d: int, side: tuple) -> int:
        sides = self.sides[d]
        if side not in sides:
            sides[side] = len(sides)
            self.kinds[d] = [_common(a, b, self.spark) for a, b in zip(self.kinds[d], self._types(side))]
            self.marks.setdefault(side[0], []).append(("key", d, side))
        return sides[side]

    def identity(self, table: str, columns) -> list[str]:
        """The columns that name a row in a sample: its table's unique key, where a rule gives one."""
        key = self.names.get(table) or next((r.keys for r in self.rules if r.keys and r.table == table), ())
        return [*[c for c in key if c not in columns], *columns]

    def ordered_by_key(self, r, at) -> bool:
        """Whether a key rule's samples come in the order of its (integer) keys."""
        kinds = self.kinds[at[0]]
        return _integers(kinds) and (len(kinds) == 1 if r.reference else self.identity(r.table, r.keys) == list(r.keys))


def _marks(plan: Plan, sampled: bool) -> DataFrame:
    """(domain, key, side, order, text) of every table's rows, one scan each. The marks of row rules
    have a negative domain and no key."""
    out, null = None, F.lit(None).cast("string")
    for table, wanted in plan.marks.items():
        df, made = plan.tables(table), []
        for kind, n, *side in wanted:
            if kind == "rule":
                predicate = plan.rules[n].predicate
                mark = F.struct(F.lit(-1 - n).alias("domain"), F.lit(None).cast("long").alias("num"), null.alias("txt"),
                                F.lit(0).alias("side"), *([null.alias("ord"), null.alias("shown")] if sampled else []))
                made.append(F.when(predicate(), mark) if predicate else mark)
                continue
            _, columns, related = side[0]
            num, txt = _key(columns, plan.kinds[n])
            shown = plan.identity(table, columns)
            seen = (n, side[0]) in plan.shown
            mark = F.struct(F.lit(n).alias("domain"), num.alias("num"), txt.alias("txt"), F.lit(plan.sides[n][side[0]]).alias("side"),
                            *([(order_text(df, shown) if seen else null).alias("ord"),
                                (row_text(shown) if seen else null).alias("shown")] if sampled else []))
            made.append(F.when(_all_known(columns), mark) if related else mark)
        rows = df.select(F.explode(F.array(*made)).alias("m")).filter(F.col("m").isNotNull()).select("m.*")
        out = rows if out is None else out.unionByName(rows)
    return out


def findings(tables: Tables, rules, sampled: bool = False, names: dict[str, tuple] | None = None,
             only: DataFrame | None = None) -> DataFrame:
    """(``rule``, ``n``, ``ord``, ``shown``, ``num``, ``txt``): every offending key of the key rules, the
    number of offending rows of each row rule, and for an emptiness rule the rows of its table.
    ``only``: a few (rule, num, txt) to look at."""
    plan = Plan(tables, rules, names)
    width = max([len(s) for s in plan.sides], default=1)
    sides = [F.count_if(F.col("side") == i).alias(f"n{i}") for i in range(width)]
    least = [F.min(F.when(F.col("side") == i, F.struct("ord", "shown"))).alias(f"m{i}") for i in range(width if sampled else 0)]
    marks = _marks(plan, sampled)
    if only is not None:
        domain = F.create_map(*[F.lit(x) for r, at in zip(plan.rules, plan.at) for x in (r.name, at[0])])
        few = F.broadcast(only.select(domain[F.col("rule")].alias("_domain"), F.col("num").alias("_num"), F.col("txt").alias("_txt")))
        marks = marks.join(few, (F.col("domain") == F.col("_domain")) & F.col("num").eqNullSafe(F.col("_num"))
                           & F.col("txt").eqNullSafe(F.col("_txt")), "left_semi")
    keyed = marks.groupBy("domain", "num", "txt").agg(*sides, *least)
    null = F.lit(None).cast("string")
    by_domain: dict[int, list[Column]] = {}
    for n, (r, at) in enumerate(zip(plan.rules, plan.at)):
        order = text = null
        if r.reference:
            d, child, parent = at
            known = F.col("num").isNotNull() | F.col("txt").isNotNull()
            bad, number = known & (F.col(f"n{child}") > 0) & (F.col(f"n{parent}") == 0), F.col(f"n{child}")
            if sampled:
                order, text = F.coalesce(sortable(F.col("num"), T.LongType()), F.col("txt")), F.col(f"m{child}.shown")
        elif r.keys:
            d, side = at
            bad, number = F.col(f"n{side}") > 1, F.lit(1)
            if sampled:
                first = F.col(f"m{side}.shown")
                order = F.col(f"m{side}.ord")
                text = F.concat(F.left(first, F.length(first) - 1), F.lit(", "), F.col(f"n{side}").cast("string"), F.lit(")"))
        else:
            d, bad, number = -1 - n, F.lit(True), F.col("n0")
        by_domain.setdefault(d, []).append(F.when(bad, F.struct(
            F.lit(r.name).alias("rule"), number.cast("long").alias("n"), order.alias("ord"), text.alias("shown"),
            F.col("num"), F.col("txt"))))
    found = None
    for d, of_domain in by_domain.items():  # a key meets the rules of its own domain only
        here = F.array(*of_domain)
        found = F.when(F.col("domain") == d, here) if found is None else found.when(F.col("domain") == d, here)
    return keyed.select(F.explode(found).alias("f")).filter(F.col("f").isNotNull()).select("f.*")


def _fused(r) -> bool:
    return bool(r.reference or r.keys or r.predicate or r.on_row_count)


def counts(tables: Tables, rules, found: DataFrame | None = None) -> DataFrame:
    """(``name``, ``ok``, ``n_offenders``) of every rule, also of those that nothing offends."""
    rules = list(rules)
    fused, parts = [r for r in rules if _fused(r)], []
    if fused:
        found = findings(tables, fused) if found is None else found
        none = found.sparkSession.range(1).select(F.explode(F.array(*[F.lit(r.name) for r in fused])).alias("name"), F.lit(0).cast("long").alias("n"))
        n = F.col("n")
        for r in fused:
            if r.on_row_count:
                n = F.when(F.col("name") == r.name, r.on_row_count(F.col("n"))).otherwise(n)
        parts.append(found.select(F.col("rule").alias("name"), "n").unionByName(none).groupBy("name").agg(F.sum("n").alias("n"))
                     .select("name", n.cast("long").alias("n_offenders")))
    for r in rules:
        if not _fused(r):
            c = r.count(tables) if r.count else r.offenders(tables).agg(F.count(F.lit(1)).alias("n_offenders"))
            parts.append(c.select(F.lit(r.name).alias("name"), F.col("n_offenders").cast("long").alias("n_offenders")))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.select("name", (F.col("n_offenders") == 0).alias("ok"), "n_offenders")


def _first_rows(tables: Tables, rules) -> DataFrame:
    """(``rule``, ``ord``, ``shown``) of the rows that offend row rules and rules of any other form."""
    out = None
    for r in rules:
        df = r.offenders(tables)
        columns = r.columns or tuple(df.columns)
        rows = df.select(F.lit(r.name).alias("rule"), order_text(df, [*r.order_by, *[c for c in columns if c not in r.order_by]]).alias("ord"),
                         row_text(columns).alias("shown"))
        out = rows if out is None else out.unionByName(rows)
    return out


def _names(rules) -> dict[str, tuple]:
    """Rows are named by the unique keys that all ``rules`` give their tables."""
    return {r.table: r.keys for r in reversed(rules) if r.keys}


def _key_samples(tables: Tables, rules, failed, found: DataFrame) -> list[DataFrame]:
    """(``rule``, ``ord``, ``shown``) of the failed key rules; the first keys of those whose samples come
    in the order of their keys are known from what was ``found``."""
    names, plan = _names(rules), Plan(tables, [r for r in rules if _fused(r)], _names(rules))
    known = {r.name for r, at in zip(plan.rules, plan.at) if at and plan.ordered_by_key(r, at)}
    by_key, others, out = [r for r in failed if r.name in known], [r for r in failed if r.name not in known], []
    if by_key:
        at = F.row_number().over(Window.partitionBy("rule").orderBy(*_key_order()))
        first = found.filter(F.col("rule").isin([r.name for r in by_key])).withColumn("at", at).filter(F.col("at") <= SAMPLE_ROWS)
        # The marks of a domain are of all its rules: a key that is the first of one rule may offend another.
        out.append(findings(tables, by_key, sampled=True, names=names, only=first.select("rule", "num", "txt")))
    if others:
        out.append(findings(tables, others, sampled=True, names=names))
    return [x.select("rule", "ord", "shown") for x in out]


def detail(tables: Tables, rules) -> DataFrame:
    """(``name``, ``ok``, ``n_offenders``, ``detail``): the counts and the first offenders of each rule.
    The report has a row for each rule; it is staged, to know which row rules failed."""
    rules = list(rules)
    spark = tables(rules[0].table).sparkSession

    def staged(df: DataFrame, name: str) -> DataFrame:
        path = work_path(spark, name)
        df.write.parquet(path)
        return spark.read.schema(df.schema).parquet(path)

    text = F.col("n_offenders").cast("string")
    fused = [r for r in rules if _fused(r)]
    found = staged(findings(tables, fused).select("rule", "n", "num", "txt"), "rule-findings") if fused else None
    report = staged(counts(tables, rules, found), "rule-counts")
    failed = {r["name"] for r in report.filter("NOT ok").select("name").collect()}
    keyed = [r for r in rules if r.name in failed and (r.reference or r.keys)]
    rows = [r for r in rules if r.name in failed and not (r.reference or r.keys or r.on_row_count)]
    parts = [*(_key_samples(tables, rules, keyed, found) if keyed else []), *([_first_rows(tables, rows)] if rows else [])]
    if not parts:
        return report.withColumn("detail", F.when(F.col("ok"), F.lit("no problems")).otherwise(F.concat(text, F.lit(" row(s)"))))
    each = Window.partitionBy("rule").orderBy("ord", "shown")
    first = reduce(DataFrame.unionByName, parts).withColumn("at", F.row_number().over(each)) \
        .filter(F.col("at") <= SAMPLE_ROWS)
    sample = first.groupBy(F.col("rule").alias("name")).agg(F.array_join(F.transform(
        F.array_sort(F.collect_list(F.struct("at", "shown"))), lambda x: x["shown"]), ", ").alias("sample"))
    return report.join(sample, "name", "left").select("name", "ok", "n_offenders", F.when(F.col("ok"), F.lit("no problems")).when(
        F.col("sample").isNull(), F.concat(text, F.lit(" row(s)"))).otherwise(
        F.concat(text, F.lit(" row(s), e.g.: "), F.col("sample"))).alias("detail"))
