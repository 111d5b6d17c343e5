"""The fused rule pass against each rule's own offenders."""

import random

import pytest

from tessera.operators import integrity as I
from tessera.operators import quality as Q


def frames(spark, seed, hot=False):
    rng = random.Random(seed)
    key = lambda: rng.choice([None, *range(1, 12)])
    parents = [(key(), rng.choice(["a", "b", None])) for _ in range(8)]
    return {
        "p": spark.createDataFrame(parents, "id int, code string"),
        "c": spark.createDataFrame([(i, 1 if hot and i % 3 else key(), key(), rng.choice(["a", "z", None])) for i in range(60)],
                                   "id bigint, p_id bigint, other bigint, code string"),
        "g": spark.createDataFrame([(key(), rng.choice(["a", "b", None]), key()) for _ in range(20)], "p_id int, code string, c_id bigint"),
        "none": spark.createDataFrame([], "id bigint"),
    }.__getitem__


RULES = [
    Q.pk_not_null("p", ("id",)), Q.unique("p", ("id",)), Q.unique("c", ("id",)), Q.unique("p", ("code",), name="unique[p.code]"),
    Q.unique("g", ("p_id", "code"), name="unique[g]"),
    Q.no_orphans("c", ("p_id",), "p", ("id",)), Q.no_orphans("c", ("other",), "p", ("id",)),
    Q.no_orphans("p", ("id",), "c", ("p_id",), name="reverse"), Q.no_orphans("g", ("p_id", "code"), "p", ("id", "code"), name="pairs"),
    Q.no_orphans("g", ("c_id",), "c", ("id",)), Q.no_orphans("c", ("code",), "p", ("code",)),
    Q.no_orphans("c", ("id",), "none", ("id",), name="empty parent"), Q.not_empty("none"), Q.not_empty("p"),
    Q.row_rule("row", "c", lambda: Q.F.col("other") > 6, columns=("id", "other"), order_by=("id",)),
    Q.custom("joined", "c", lambda t: t("c").join(t("p").select(Q.F.col("id").alias("p_id")).distinct(), "p_id").select("id"), order_by=("id",)),
]


@pytest.mark.parametrize("seed,hot", [(1, False), (2, True), (3, False)])
def test_counts_equal_each_rules_own_offenders(spark, seed, hot):
    t = frames(spark, seed, hot)
    got = {r["name"]: (r["ok"], r["n_offenders"]) for r in I.counts(t, RULES).collect()}
    want = {}
    for r in RULES:
        n = r.count(t).first()[0] if r.count else r.offenders(t).count()
        want[r.name] = (n == 0, n)
    assert got == want


def test_detail_shows_the_first_offenders(spark):
    t = {"p": spark.createDataFrame([(1,), (2,), (2,)], "id int"),
         "c": spark.createDataFrame([(i, 2 if i < 4 else 100 - i, None if i == 9 else -i) for i in range(10)], "id bigint, p_id bigint, v bigint")}
    rules = [Q.unique("p", ("id",)), Q.unique("c", ("id",)), Q.no_orphans("c", ("p_id",), "p", ("id",)), Q.not_empty("p"),
             Q.row_rule("negative", "c", lambda: Q.F.col("v") < 0, columns=("id", "v"), order_by=("v",)),
             Q.row_rule("unknown", "c", lambda: Q.F.col("v").isNull(), order_by=("id",))]
    got = {r["name"]: r["detail"] for r in I.detail(t.__getitem__, rules).collect()}
    assert got == {"pk_unique[p]": "1 row(s), e.g.: (2, 2)", "pk_unique[c]": "no problems", "not_empty[p]": "no problems",
                   "no_orphans[c.p_id]": "6 row(s), e.g.: (9, 91), (8, 92), (7, 93)",
                   "negative": "8 row(s), e.g.: (8, -8), (7, -7), (6, -6)", "unknown": "1 row(s), e.g.: (9, 91, NULL)"}


def test_detail_without_a_finding(spark):
    t = {"p": spark.createDataFrame([(1,)], "id int")}.__getitem__
    assert [r["detail"] for r in I.detail(t, [Q.unique("p", ("id",)), Q.not_empty("p")]).collect()] == ["no problems"] * 2


def test_one_scan_per_table_and_one_shuffle_of_rows(spark):
    from tessera.plans import standins as SI

    t = SI.reader(spark, "/root/testdata/sf0.001")
    rules = [r for r in SI.standin_rules() if r.reference or r.keys or r.predicate or r.on_row_count]
    plan = I.counts(t, rules)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == len(SI.KEYS) and plan.count("Exchange hashpartitioning") == 2


def test_sortable_orders_like_the_values(spark):
    values = [-(2**63), -10, -9, 0, 9, 10, 2**63 - 1, None]
    df = spark.createDataFrame([(v,) for v in values], "v bigint")
    got = [r["v"] for r in df.orderBy(I.sortable(df["v"], df.schema["v"].dataType)).collect()]
    assert got == [None, *values[:-1]]


def test_samples_look_at_the_first_offending_keys_only(spark):
    """Where samples come in the order of integer keys (also negative ones, NULL and composite ones), no
    sorted aggregation of all marks finds them; other rules are sampled as before."""
    p = spark.createDataFrame([(i,) for i in range(-20, 20)], "id long")
    c = spark.createDataFrame([(i - 30, i % 4 or None, str(i % 5)) for i in range(100)] * 2, "fk long, line int, name string")
    t = {"p": p, "c": c}
    rules = [Q.unique("p", ("id",)), Q.unique("c", ("fk", "line")), Q.no_orphans("c", ("fk",), "p", ("id",)),
             Q.unique("c", ("name",), name="unique[c.name]")]
    got = {r["name"]: (r["n_offenders"], r["detail"]) for r in I.detail(t.__getitem__, rules).collect()}
    assert got["unique[c.name]"][0] == 5 and got["unique[c.name]"][1].startswith("5 row(s), e.g.: (-30, NULL, 0, 40)")
    keyed = [(n, d.split("e.g.: ")[1]) for n, d in got.values() if "(-30, NULL, 2), (-29, 1, 2), (-28, 2, 2)" in d]
    assert keyed == [(100, "(-30, NULL, 2), (-29, 1, 2), (-28, 2, 2)")]
    orphans = [v for k, v in got.items() if k.startswith("no_orphans")]
    assert orphans == [(120, "120 row(s), e.g.: (NULL, -30), (1, -29), (2, -28)")]
    found = I.findings(t.__getitem__, rules[:3]).select("rule", "n", "num", "txt")
    parts = I._key_samples(t.__getitem__, rules, rules[:3], found)
    assert len(parts) == 1 and "LeftSemi" in parts[0]._jdf.queryExecution().optimizedPlan().toString()
