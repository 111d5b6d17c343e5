"""Exact running balances of a bill with very many payments, without one task for the whole bill.

A payment turns a balance b (cents) into max(b + round(b * rate) - amount, 0). The step is strictly
increasing above zero and drives two balances apart, so nothing can be said about a late payment
without the earlier ones: a fold of the whole bill is the plain way. But the step can be bounded
from behind. For a stretch of payments let

* ``low`` be the largest balance before the stretch that is zero after it, and
* ``high`` the largest one that never passes the largest balance the column can hold.

Both follow from the last payment backwards: before a payment of a, the largest balance that ends at
most at x is the largest b with b + round(b * rate) <= x + a, a closed form in integers. As the step
spreads balances by 1 + rate, this backward pass draws ``low`` and ``high`` together: after some
fifteen hundred payments at 2 % no more than about 1 / rate balances lie between them. A bill's
payments are cut into range pieces, and each piece is summed up by ``low``, ``high`` and what becomes
of every balance in between (a short list); a piece too short for that keeps its few amounts.

The pieces of a bill are then followed in order, one lookup or short fold each, which gives every
piece its incoming balance; with it all pieces are folded at the same time. A task holds the amounts
of one piece, or the summaries of one bill, whatever the bill's payments do: settle it early, never,
or only cover its surcharges.

A payment after which the balance would not fit its column is refused, and the balance stays. That
can only happen in pieces whose incoming balance is above ``high``. Such a piece refuses all of its
payments if the balance would outgrow the column even with the largest of them; else that one piece
is folded by a job of its own before its bill is followed further.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Largest balance in cents that decimal(12,2) can hold.
LARGEST = 10**12 - 1


def step(balance, rate: int, amount: int):
    """(surcharge, new balance) in cents; ``rate`` in thousandths, half up."""
    surcharge = (balance * rate + 500) // 1000
    return surcharge, max(balance + surcharge - amount, 0)


def step_or_refuse(balance, rate: int, amount: int, largest: int):
    """(surcharge, new balance, refused): a payment that leaves more than ``largest`` changes nothing."""
    surcharge, after = step(balance, rate, amount)
    return (surcharge, balance, True) if after > largest else (surcharge, after, False)


def largest_before(after: int, rate: int) -> int:
    """The largest balance that with its surcharge is at most ``after``."""
    return (1000 * after + 499) // (1000 + rate)


def bounds(amounts: list[int], rate: int, largest: int = LARGEST) -> tuple[int, int]:
    """(low, high) of a stretch of payments."""
    low, high = 0, largest
    for a in reversed(amounts):
        low = largest_before(low + a, rate)
        high = min(largest, largest_before(high + a, rate))
    return min(low, high), high


def widest(rate: int) -> int:
    """So many balances between low and high are listed; long stretches leave about half of it."""
    return max(256, 4 * (1000 // max(rate, 1) + 1))


def summary(amounts: list[int], rate: int, largest: int = LARGEST) -> tuple[int, int, list[int] | None, list[int] | None]:
    """(low, high, balances after the stretch of low + 1 .. high, or else the amounts)."""
    low, high = bounds(amounts, rate, largest)
    if high - low > widest(rate):
        return low, high, None, amounts
    b = np.arange(low + 1, high + 1, dtype=np.int64)
    for a in amounts if len(b) else ():
        b = b + (b * rate + 500) // 1000 - a
    return low, high, b.tolist(), None


def follow(balance: int, low: int, high: int, outs: list[int] | None, amounts: list[int] | None, rate: int) -> int:
    """The balance after a summed-up stretch."""
    if balance <= low:
        return 0
    if balance > high:
        raise ValueError(f"a balance passes {LARGEST} cents")
    if outs is not None:
        return int(outs[balance - low - 1])
    for a in amounts:
        _, balance = step(balance, rate, a)
    return balance


def end_with_refusals(balance: int, amounts, rate: int, largest: int) -> int:
    """The balance after a stretch of payments of which some may be refused."""
    for a in amounts:
        _, balance, _ = step_or_refuse(balance, rate, int(a), largest)
    return balance


def _runs(keys: list[np.ndarray]) -> list[tuple[int, int]]:
    """(first, end) of every run of equal keys."""
    n = len(keys[0])
    new = np.zeros(n, bool)
    new[:1] = True
    for k in keys:
        new[1:] |= k[1:] != k[:-1]
    firsts = np.flatnonzero(new).tolist()
    return list(zip(firsts, [*firsts[1:], n]))


def fold_in_pieces(rows: DataFrame, bill_key: str, order_cols: list[str], cols: list[str], n_partitions: int,
                   stage_path: str, largest: int = LARGEST) -> DataFrame:
    """``cols`` of ``rows`` with ``seq``, ``_surcharge_c``, ``_balance_c`` and ``_refused`` (the new
    balance would be above ``largest`` cents). ``rows`` also has
    ``_amount_c``, ``_start_c`` (cents) and ``_rate_m`` (thousandths); rates and starts are of the
    bill. Pieces, like their summaries, are staged: a lost task repeats its own piece only."""
    spark, piece = rows.sparkSession, [bill_key, "_pid"]
    (rows.repartitionByRange(n_partitions, bill_key, *order_cols).withColumn("_pid", F.spark_partition_id())
     .write.mode("overwrite").parquet(f"{stage_path}/pieces"))
    pieces = spark.read.parquet(f"{stage_path}/pieces")
    kind = dict(rows.dtypes)[bill_key]

    def by_piece(batches: Iterator[pd.DataFrame], done, names: list[str], last: str) -> Iterator[pd.DataFrame]:
        """``done(key, amounts, last, rate)`` of each piece's amounts in order."""
        key, amounts, of_bill, rate = None, [], 0, 0
        for pdf in batches:
            out = []
            bill, pid = pdf[bill_key].to_numpy(), pdf["_pid"].to_numpy()
            for first, end in _runs([bill, pid]):
                if key != (bill[first], pid[first]):
                    out += [done(key, amounts, of_bill, rate)] if key is not None else []
                    key, amounts = (bill[first], pid[first]), []
                    of_bill, rate = int(pdf[last].iloc[first]), int(pdf["_rate_m"].iloc[first])
                amounts += pdf["_amount_c"].iloc[first:end].tolist()
            yield pd.DataFrame(out, columns=names)
        if key is not None:
            yield pd.DataFrame([done(key, amounts, of_bill, rate)], columns=names)

    def summarise(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        def done(key, amounts, start, rate) -> tuple:
            low, high, outs, kept = summary(amounts, rate, largest)
            return (*key, len(amounts), start, rate, low, high, max(amounts), outs, kept)

        return by_piece(batches, done, [bill_key, "_pid", "n", "start", "rate", "low", "high", "most", "outs", "amounts"], "_start_c")

    def ends(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        def done(key, amounts, balance, rate) -> tuple:
            return (*key, end_with_refusals(balance, amounts, rate, largest))

        return by_piece(batches, done, [bill_key, "_pid", "end"], "_in")

    def incoming(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("_pid")
        balance, before, out = None, 0, []
        for r in pdf.itertuples(index=False):
            balance = int(r.start) if balance is None else balance
            rate, above = int(r.rate), balance > int(r.high)
            stuck = above and balance > largest_before(largest + int(r.most), rate)
            open_ = above and not stuck and r.amounts is None and pd.isna(r.end)
            out.append((r[0], r[1], balance, before, open_))
            if open_:
                break
            before += int(r.n)
            if not above:
                balance = follow(balance, int(r.low), int(r.high), r.outs, r.amounts, rate)
            elif not stuck:
                balance = int(r.end) if r.amounts is None else end_with_refusals(balance, r.amounts, rate, largest)
        return pd.DataFrame(out, columns=[bill_key, "_pid", "_in", "_before", "_open"])

    def in_order(df: DataFrame) -> DataFrame:
        return df.repartition(n_partitions, *piece).sortWithinPartitions(*piece, *order_cols)

    needed = [*piece, *[c for c in order_cols if c not in piece], "_amount_c", "_start_c", "_rate_m"]
    (in_order(pieces.select(*needed)).mapInPandas(
        summarise, f"`{bill_key}` {kind}, _pid int, n long, start long, rate long, low long, high long, most long, "
                   "outs array<long>, amounts array<long>")
     .write.mode("overwrite").parquet(f"{stage_path}/sums"))
    sums = spark.read.parquet(f"{stage_path}/sums")
    ended = sums.select(*piece, F.lit(None).cast("long").alias("end")).where(F.lit(False))
    found: list[str] = []
    while True:
        path = f"{stage_path}/incoming-{len(found)}"
        (sums.join(ended, piece, "left").groupBy(bill_key)
         .applyInPandas(incoming, f"`{bill_key}` {kind}, _pid int, _in long, _before long, _open boolean")
         .write.mode("overwrite").parquet(path))
        begins = spark.read.parquet(path)
        to_fold = begins.where("_open").select(*piece, "_in")
        if to_fold.isEmpty():
            break
        # Rare: one piece of each bill that goes on above ``high`` and is not refused whole.
        found.append(f"{stage_path}/ends-{len(found)}")
        (in_order(pieces.select(*needed).join(to_fold, piece)).mapInPandas(ends, f"`{bill_key}` {kind}, _pid int, end long")
         .write.mode("overwrite").parquet(found[-1]))
        ended = spark.read.schema(ended.schema).parquet(*found)
    begun = pieces.join(begins.drop("_open"), piece)

    def fold(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        key, balance, seq = None, 0, 0
        for pdf in batches:
            surcharges, balances, seqs, refusals = [], [], [], []
            bill, pid = pdf[bill_key].to_numpy(), pdf["_pid"].to_numpy()
            for first, end in _runs([bill, pid]):
                if key != (bill[first], pid[first]):
                    key = (bill[first], pid[first])
                    balance, seq = int(pdf["_in"].iloc[first]), int(pdf["_before"].iloc[first])
                rate = int(pdf["_rate_m"].iloc[first])
                for a in pdf["_amount_c"].iloc[first:end].tolist():
                    s, balance, refused = step_or_refuse(balance, rate, a, largest)
                    seq += 1
                    refusals.append(refused)
                    surcharges.append(s)
                    balances.append(balance)
                    seqs.append(seq)
            yield pdf[cols].assign(seq=pd.Series(seqs, dtype="int64", index=pdf.index),
                                   _surcharge_c=pd.Series(surcharges, dtype="int64", index=pdf.index),
                                   _balance_c=pd.Series(balances, dtype="int64", index=pdf.index),
                                   _refused=pd.Series(refusals, dtype="bool", index=pdf.index))

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.select(*cols).schema.fields)
    return in_order(begun).mapInPandas(fold, f"{fields}, seq bigint, _surcharge_c bigint, _balance_c bigint, _refused boolean")


def money(cents: str, kind: str) -> Column:
    return (F.col(cents).cast("decimal(20,0)") / F.lit(100)).cast(kind)
