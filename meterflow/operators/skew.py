"""Skew-safe building blocks.

A single site (or site-day) may hold a third of all readings.  Two patterns
keep such a group from landing in one task:

* :func:`salted_join` joins the big side to a per-group statistics table.  By
  default it is a plain join: adaptive execution broadcasts the statistics
  when they are small and splits skewed partitions otherwise.  Where salts
  are asked for, the key gets a deterministic hash of the big side's row
  (task retries see the same assignment) and the small side is replicated
  once per salt value.
* :func:`exact_percentiles` computes exact interpolated percentiles per
  group without gathering a group's values: a mergeable sketch brackets the
  target ranks, then only the values inside the bracket are counted.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Sketches find a rank with an error of at most 1/accuracy of the group's size.
SKETCH_ACCURACY = 10_000


def salt_of(cols: list[str], buckets: int) -> Column:
    return F.pmod(F.xxhash64(*[F.col(c) for c in cols]), F.lit(buckets)).cast("int")


def salted_join(big: DataFrame, small: DataFrame, on: list[str], salt_cols: list[str],
                buckets: int | None = None, how: str = "inner") -> DataFrame:
    """Equi-join ``big`` to a per-key table; with ``buckets``, hot keys are spread over so many tasks."""
    if not buckets:
        return big.join(small, on, how)
    b = big.withColumn("_salt", salt_of(salt_cols, buckets))
    s = small.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(buckets - 1))))
    return b.join(s, on + ["_salt"], how).drop("_salt")


def sketch_quantiles(value: str, probs: list[float], accuracy: int = SKETCH_ACCURACY) -> Column:
    """Aggregate of bounded size: approximate quantiles on both sides of each probability (ascending), as one array.

    The two lie 3/accuracy below and above, so with the sketch's own error
    they bracket the wanted ranks with a margin of 2/accuracy of the group.
    """
    d = 3 / accuracy
    return F.percentile_approx(value, [min(max(q, 0.0), 1.0) for p in probs for q in (p - d, p + d)], accuracy)


def ranked_percentiles(vals: DataFrame, bounds: DataFrame, keys: list[str], value: str, probs: list[float], salt_cols: list[str],
                       accuracy: int = SKETCH_ACCURACY, small_group: int | None = None, prefix: str = "p", carry: list[str] = ()) -> DataFrame:
    """Exact continuous percentiles of ``vals`` per group, ranked inside given brackets.

    ``bounds``: ``keys``, ``n`` and ``bracket`` (:func:`sketch_quantiles` for
    the same, ascending ``probs``).  A value outside all brackets collapses
    into the count of its gap during the partial aggregation, so a group's
    sort holds the distinct values of its brackets only.  Groups of up to
    ``small_group`` values (``accuracy`` unless given: below that a bracket
    may be narrower than the neighbouring ranks) keep all of theirs.  A rank
    that falls into a gap is an error, never a wrong value.  Returns ``keys``,
    ``n`` (values ranked), the columns ``carry`` of ``bounds`` and one column
    ``{prefix}{i}`` per probability.
    """
    small_group = accuracy if small_group is None else small_group
    d = 3 / accuracy
    ninf, pinf = F.lit(float("-inf")), F.lit(float("inf"))
    x = F.col("_x")
    low = [ninf if p - d <= 0 else F.col("bracket")[2 * i] for i, p in enumerate(probs)]
    high = [pinf if p + d >= 1 else F.col("bracket")[2 * i + 1] for i, p in enumerate(probs)]
    j = salted_join(vals.select(*keys, *[c for c in salt_cols if c not in keys], F.col(value).alias("_x")).where("_x IS NOT NULL"),
                    bounds.select(*keys, "n", "bracket", *carry), keys, salt_cols)
    inside = F.col("n") <= small_group
    below = ninf  # a gap is named by the upper edge of the bracket below it
    for lo, hi in zip(low, high):
        inside = inside | ((x >= lo) & (x <= hi))
        below = F.when(x > hi, hi).otherwise(below)
    j = j.select(*keys, *carry, F.when(inside, x).otherwise(below).alias("_xk"), (~inside).alias("_gap"))
    counts = j.groupBy(*keys, *carry, "_xk", "_gap").agg(F.count(F.lit(1)).alias("_c"))

    group = Window.partitionBy(*keys)
    upto = group.orderBy("_xk", "_gap").rowsBetween(Window.unboundedPreceding, 0)
    t = counts.withColumns({"_cum": F.sum("_c").over(upto), "n": F.sum("_c").over(group)})
    start = F.col("_cum") - F.col("_c")

    def at(rank: Column) -> Column:
        hit = (start <= rank) & (rank < F.col("_cum"))
        broken = F.raise_error(F.lit("a percentile's rank lies outside its bracket")).cast("double")
        return F.max(F.when(hit, F.when(F.col("_gap"), broken).otherwise(F.col("_xk"))))

    picks = {}
    for i, p in enumerate(probs):
        r = F.lit(p) * (F.col("n") - 1)
        picks[f"_l{i}"], picks[f"_h{i}"] = at(F.floor(r)), at(F.ceil(r))
    picked = t.groupBy(*keys, *carry, "n").agg(*[c.alias(k) for k, c in picks.items()])
    r = [F.lit(p) * (F.col("n") - 1) for p in probs]
    return picked.select(*keys, *carry, "n", *[(F.col(f"_l{i}") + (r[i] - F.floor(r[i])) * (F.col(f"_h{i}") - F.col(f"_l{i}"))).alias(f"{prefix}{i}")
                                       for i in range(len(probs))])


def exact_percentiles(df: DataFrame, keys: list[str], value: str, probs: list[float],
                      salt_cols: list[str], accuracy: int = SKETCH_ACCURACY,
                      small_group: int | None = None, prefix: str = "p") -> DataFrame:
    """Exact continuous percentiles (linear interpolation between the two
    neighbouring ranks, as ``percentile`` / ``quantile_cont``) per group,
    for ascending ``probs``: a sketch brackets the ranks, then the values
    inside the brackets are ranked.  Returns ``keys`` + ``n`` + one column
    ``{prefix}{i}`` per probability.
    """
    vals = df.where(F.col(value).isNotNull())
    bounds = vals.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), sketch_quantiles(value, probs, accuracy).alias("bracket"))
    return ranked_percentiles(vals, bounds, keys, value, probs, salt_cols, accuracy, small_group, prefix)
