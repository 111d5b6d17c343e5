"""Claims and damage per policy, kept up to date batch by batch.

The report of ``operators.claims`` reads every staged claim. Here two small states are kept instead:
one row per claim (its policy and amount) and one per policy (claims and damage). A batch takes the
former amount of every claim it exports again back from the claim's former policy, adds the new one
to the new policy, and adds up both per policy. Only policies that the batch touches change.

Both states are dealt into hash buckets of their key, and a bucket is a folder of its own named in
the database's manifest. A run reads its batch and the buckets its claims and policies fall into,
writes these buckets anew, and commits all of them, with the number of the batch, in one manifest:
a lost driver leaves the state before or after the batch, never between, and a batch that is
applied again is left alone.

Amounts are summed unrounded in decimals, so taking back and adding are exact. A claim without an
amount counts as a claim; a policy none of whose claims has an amount has no damage (NULL), and one
without claims has no row. Of a claim that a batch holds several times the newest row counts.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.operators.claims import EXACT, MONEY_SUM
from tessera.operators.flatten import one_row_per_key
from tessera.plans import manifest as M
from tessera.plans.publish import new_version_id
from tessera.session import work_path

CLAIMS, POLICIES, APPLIED = "claim_state", "policy_state", "claims_applied"
BUCKETS = 64
_SUM = "decimal(38,10)"


@dataclass(frozen=True)
class Applied:
    """What a batch did: the state after it, and the buckets of either state that it read and wrote."""

    state: M.Snapshot
    done: bool
    claim_buckets: tuple[int, ...] = ()
    policy_buckets: tuple[int, ...] = ()


def _entry(table: str, bucket: int) -> str:
    return f"{table}.b{bucket:05d}".replace(".", "/")


def _read(spark: SparkSession, state: M.Snapshot, table: str, like: DataFrame, buckets=None) -> DataFrame:
    """The rows of a state, or of some of its buckets."""
    names = [n for n in state.tables if n.startswith(f"{table}/")] if buckets is None else [_entry(table, b) for b in buckets]
    paths = [state.tables[n].path for n in names if n in state.tables]
    return spark.read.schema(like.schema).parquet(*paths) if paths else like.limit(0)


def _write(spark: SparkSession, rows: DataFrame, table: str, root: str, database: str, buckets) -> dict[str, M.Entry | None]:
    """Write some buckets anew; the manifest entries of those with rows, None for the others."""
    path = f"{root}/{database}/{table}/v={new_version_id()}"
    rows.repartition("bucket").write.mode("error").partitionBy("bucket").parquet(path)
    columns = rows.drop("bucket").schema
    there = spark.read.schema(rows.schema).parquet(path).groupBy("bucket").count().collect()  # one row a bucket
    made = {r["bucket"]: M.Entry(f"{path}/bucket={r['bucket']}", r["count"], columns.json()) for r in there}
    return {_entry(table, b): made.get(b) for b in buckets}


def _bucket(key: str, n: int):
    return F.pmod(F.xxhash64(F.col(key)), F.lit(n)).cast("int")


def apply_batch(spark: SparkSession, staged: DataFrame, batch: int, root: str, database: str, *,
                claim_key: str = "claim_id", policy_key: str = "policy_number", damage: str = "estimated_damage_usd",
                buckets: int = BUCKETS) -> Applied:
    """Bring both states up to a batch of flattened claim rows. Batches have ascending numbers; one
    that is not above the last applied changes nothing. ``buckets`` is fixed by the first batch."""
    base = M.snapshot(spark, root, database)
    last = base.entry(APPLIED)
    if last and int(last.batch) >= batch:
        return Applied(base, False)
    if last:
        buckets = last.rows
    work = work_path(spark, "claim-batch")

    def kept(df: DataFrame, name: str) -> DataFrame:
        df.write.parquet(f"{work}/{name}")
        return spark.read.schema(df.schema).parquet(f"{work}/{name}")

    def touched(df: DataFrame) -> tuple[int, ...]:
        return tuple(sorted(r[0] for r in df.select("bucket").distinct().collect()))  # at most ``buckets``

    rows = one_row_per_key(staged, claim_key, [policy_key, damage])
    new = kept(rows.select(F.col(claim_key).alias("claim"), F.col(policy_key).alias("policy"),
                           F.col(damage).cast(EXACT).alias("amount")).withColumn("bucket", _bucket("claim", buckets)), "new")
    claim_buckets = touched(new)
    old = _read(spark, base, CLAIMS, new.drop("bucket"), claim_buckets)
    exported, same = new.select(F.col("claim").alias("_claim")), F.col("claim").eqNullSafe(F.col("_claim"))
    again = old.join(exported, same, "left_semi")

    def share(df: DataFrame, sign: int) -> DataFrame:
        return df.select("policy", F.lit(sign).cast("long").alias("claims"), (F.col("amount") * sign).cast(_SUM).alias("damage"),
                         F.when(F.col("amount").isNotNull(), sign).otherwise(0).cast("long").alias("amounts"))

    def added(df: DataFrame) -> DataFrame:
        return df.groupBy("policy").agg(F.sum("claims").alias("claims"), F.coalesce(F.sum("damage"), F.lit(0)).cast(_SUM).alias("damage"),
                                        F.sum("amounts").alias("amounts"))

    delta = kept(added(share(again, -1).unionByName(share(new, 1))).filter("claims <> 0 OR damage <> 0 OR amounts <> 0")
                 .withColumn("bucket", _bucket("policy", buckets)), "delta")
    policy_buckets = touched(delta)
    totals = added(_read(spark, base, POLICIES, delta.drop("bucket"), policy_buckets).unionByName(delta.drop("bucket"))) \
        .filter("claims > 0").withColumn("bucket", _bucket("policy", buckets))
    claims = old.join(exported, same, "left_anti").withColumn("bucket", _bucket("claim", buckets)).unionByName(new)
    changes = {**_write(spark, claims, CLAIMS, root, database, claim_buckets),
               **_write(spark, totals, POLICIES, root, database, policy_buckets),
               APPLIED: M.Entry("", buckets, "", str(batch))}
    return Applied(M.commit(spark, base, changes), True, claim_buckets, policy_buckets)


def claims_by_policy(spark: SparkSession, state: M.Snapshot, policies: DataFrame, *, policy_key: str = "policy_number",
                     policy_columns: tuple[str, ...] = ()) -> DataFrame:
    """The report of ``operators.claims.claims_by_policy`` from the kept state."""
    key = policies.schema[policy_key].dataType.simpleString()
    like = spark.createDataFrame([], f"policy {key}, claims long, damage {_SUM}, amounts long")
    totals = _read(spark, state, POLICIES, like)
    return (totals.withColumnRenamed("policy", policy_key).join(policies.select(policy_key, *policy_columns), policy_key)
            .select(policy_key, *policy_columns, "claims",
                    F.when(F.col("amounts") > 0, F.round("damage", 2).cast(MONEY_SUM)).alias("damage_usd")))
