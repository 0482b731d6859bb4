"""Joins whose hot keys are known before, so that no task gets all of one."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Hot keys up to which their list is broadcast. There are at most as many as rows made over the bound.
BROADCAST_KEYS = 1_000_000


def fan_out(left: DataFrame, right: DataFrame, key: str, bound: int) -> DataFrame:
    """(key, shares): keys of which a join makes more than `bound` rows, and into how many shares of about that size they are cut.

    Counted by key on both sides first; both counts are combined before they are shuffled.
    """
    count = lambda df, name: df.where(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias(name))
    made = F.col("_l") * F.greatest(F.col("_r"), F.lit(1))
    both = count(left, "_l").where(F.col("_l") > 1).join(count(right, "_r"), key)
    return both.where(made > bound).select(key, F.least(F.ceil(made / bound), F.col("_l")).cast("int").alias("shares"))


def spread_join(left: DataFrame, right: DataFrame, key: str, also: Column | None = None, how: str = "left", bound: int = 1_000_000) -> DataFrame:
    """left joined with right by `key` (a column of both; the result has it once), and by `also`, which may name columns of both.

    Rows of the left side with a hot key are dealt to its shares by a hash of all their columns, and the right
    side's rows of that key go to each share. All other rows are joined as ever. No row is lost or doubled. Inner and left joins only.
    """
    if how not in ("inner", "left"):
        raise ValueError(f"no spread {how} join")
    hot = fan_out(left, right, key, bound)
    if hot.limit(BROADCAST_KEYS + 1).count() <= BROADCAST_KEYS:
        hot = F.broadcast(hot)
    shares = F.coalesce("shares", F.lit(1))
    dealt = left.join(hot, key, "left").withColumn("_share", F.pmod(F.xxhash64(*left.columns), shares).cast("int")).drop("shares")
    copies = right.join(hot, key, "left").withColumn("_copy", F.explode(F.sequence(F.lit(0), shares - 1))).drop("shares").withColumnRenamed(key, "_other")
    on = (F.col(key) == F.col("_other")) & (F.col("_share") == F.col("_copy"))
    joined = dealt.join(copies, on if also is None else on & also, how)
    return joined.drop("_other", "_share", "_copy")
