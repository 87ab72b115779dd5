"""Comparing all entries of a key without gathering a hot key in one task."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def in_pairs_of_blocks(entries: DataFrame, key: list[str], block: int, group_entries: int) -> DataFrame:
    """``entries`` (uid, ``key``, n: entries of the key, ...) dealt so that any two entries of a key meet in one task group.

    A key with up to ``block`` entries is one block. A larger one is split by hash, and every pair of its blocks (lo <= hi) is a
    comparison of its own. Adds mine (the entry's block), lo, hi and ``group``; groups hold about ``group_entries`` entries.
    """
    groups = -(-entries.count() // group_entries) or 1
    blocks = F.ceil(F.col("n") / block).cast("int")
    dealt = entries.withColumn("mine", F.pmod(F.xxhash64("uid"), blocks).cast("int"))
    # an entry of block i takes part in the comparison of i and j for every block j
    pairs = F.transform(F.sequence(F.lit(0), blocks - 1), lambda j: F.struct(F.least(j, F.col("mine")).alias("lo"), F.greatest(j, F.col("mine")).alias("hi")))
    dealt = dealt.withColumn("p", F.explode(pairs)).select(*entries.columns, "mine", F.col("p.lo").alias("lo"), F.col("p.hi").alias("hi"))
    return dealt.withColumn("group", F.pmod(F.xxhash64(*key, "lo", "hi"), F.lit(groups)))
