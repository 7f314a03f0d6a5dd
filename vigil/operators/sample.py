"""Sampling, splitting, limits and class vocabularies (U2-U7, M1/M2 twins).

Two families:

* the reference's own randomised forms (``bernoulli_sample``,
  ``random_split``) built on Spark's seeded samplers, and
* hash-ordered forms that give the same rows in any engine and on any
  partitioning (``hash_sample``, ``hash_split``, ``class_capped_sample``,
  ``benign_cap``), used where results must be reproducible.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Above this many groups the threshold table is shuffle-joined, not broadcast.
BROADCAST_GROUPS_MAX = 100_000

from vigil.functions.columns import hash_uniform


def uniform_from_key(key, seed: int = 0) -> Column:
    """Deterministic pseudo-uniform number in [0, 1) from an integer key."""
    return hash_uniform(key, seed)


def bernoulli_sample(df: DataFrame, fraction: float, seed: int = 42) -> DataFrame:
    """Bernoulli sample without replacement (reference semantics)."""
    if fraction >= 1.0:
        return df
    return df.sample(withReplacement=False, fraction=fraction, seed=seed)


def random_split(df: DataFrame, weights=(0.8, 0.2), seed: int = 42):
    """U4: seeded random split (reference semantics)."""
    return df.randomSplit(list(weights), seed=seed)


def hash_sample(df: DataFrame, u_col: str, fraction: float) -> DataFrame:
    """U2, reproducible twin: keep rows whose hash-uniform is below ``fraction``.

    A plain filter: map-only, pushed into the scan's codegen stage.
    """
    return df.filter(F.col(u_col) < F.lit(float(fraction)))


def hash_split(df: DataFrame, u_col: str, train_fraction: float = 0.8,
               out: str = "split") -> DataFrame:
    """U4, reproducible twin: label rows 'train' / 'test' by hash bucket."""
    return df.withColumn(out, F.when(F.col(u_col) < F.lit(float(train_fraction)),
                                     F.lit("train")).otherwise(F.lit("test")))


def limit_rows(df: DataFrame, n: int) -> DataFrame:
    """Row limit, 0 = off (reference semantics: any n rows)."""
    return df.limit(n) if n and n > 0 else df


def ordered_limit(df: DataFrame, n: int, order: Sequence[str]) -> DataFrame:
    """U3, deterministic: the first n rows in ``order`` (TakeOrderedAndProject:
    each partition keeps n rows, so only n x partitions rows move)."""
    return df.orderBy(*order).limit(n)


# A bucket of the hash is this fraction of its values' size, so a cut overshoots by as little.
BUCKETS_A_DOUBLING, HASH_BITS = 1024, 31


def hash_bucket(u) -> Column:
    """Monotone bucket of a number in [0, 1): 1,024 to each doubling, null first.

    Buckets get finer towards 0, so the cut of a cap is met within 0.1 % of it
    whatever share of a group the cap is.
    """
    h = F.greatest(F.floor(u * float(1 << HASH_BITS)), F.lit(0))
    e = F.floor(F.log2(F.greatest(h, F.lit(1)).cast("double")))
    within = F.floor((h / F.pow(F.lit(2.0), e) - 1) * BUCKETS_A_DOUBLING)
    return F.when(u.isNull(), F.lit(-1)).when(h < 1, F.lit(0)) \
        .otherwise((e + 1) * BUCKETS_A_DOUBLING + within).cast("int")


def hash_prefix(df: DataFrame, u_col: str, cap: int, group_col: str | None = None,
                group_caps: dict | None = None, materialize: bool = False) -> DataFrame:
    """Rows that can be among the first ``cap`` (per group) in ``u_col`` order.

    A bottom-k summary finds each group's cut in one pass: rows are counted by
    (group, bucket of the hash), which merges in every task (at most 33 x 1,024 counts
    a group), and running counts give the bucket in which the cap is reached.  The
    counts are exact, so the buckets up to it hold the first ``cap`` rows for certain and
    few more; what follows sorts those, not the whole input.  A null hash sorts
    first.  ``group_caps`` raises the cap of single groups; ``materialize`` freezes the
    bounded result, so the big input is read twice in all.
    """
    from vigil.operators.align import frozen
    g = F.lit(0) if group_col is None else F.col(group_col)
    caps = {k: max(v, cap) for k, v in (group_caps or {}).items()}
    cap_of = F.lit(cap)
    for k, v in caps.items():
        cap_of = F.when(F.col("_g") == F.lit(k), F.lit(v)).otherwise(cap_of)
    counts = df.groupBy(g.alias("_g"), hash_bucket(F.col(u_col)).alias("_b")).agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy("_g").orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    # the buckets that start below the cap
    cuts = frozen(counts.withColumn("_before", F.coalesce(F.sum("_n").over(before), F.lit(0)))
                  .where(F.col("_before") < cap_of).groupBy("_g").agg(F.max("_b").alias("_cut")))
    side = F.broadcast(cuts) if cuts.count() <= BROADCAST_GROUPS_MAX else cuts
    pre = df.join(side, g.eqNullSafe(F.col("_g"))).filter(hash_bucket(F.col(u_col)) <= F.col("_cut")) \
        .drop("_g", "_cut")
    return frozen(pre) if materialize else pre


def salt_of(salts: int) -> Column:
    """Deals rows to ``salts`` even groups by their place, whatever they hold: equal
    rows, and rows with one hash, are spread like all others."""
    return F.pmod(F.monotonically_increasing_id(), F.lit(salts)).cast("int")


def class_capped_sample(df: DataFrame, class_col: str, cap: int,
                        order: Sequence[str], salts: int = 64,
                        uniform_first: bool = True, materialize: bool = True) -> DataFrame:
    """At most ``cap`` rows per class, the first ones in hash ``order``.

    With ``uniform_first`` (``order[0]`` is a [0, 1) hash) the input is first
    cut to about ``cap`` rows per class by :func:`hash_prefix`, so the
    shuffle below moves a few ``cap`` rows per class, not the whole input.
    A class may hold a third of all rows, so it is never sorted in one task:
    stage 1 splits every class into ``salts`` sub-groups and keeps the first
    ``cap`` of each; stage 2
    ranks the at most ``salts * cap`` survivors per class.  Exact, because a
    row among a class's first ``cap`` is among its sub-group's, however rows are dealt.
    """
    if uniform_first:
        df = hash_prefix(df, order[0], cap, class_col, materialize=materialize)
    ordering = [F.col(c) for c in order]
    w1 = Window.partitionBy(class_col, "_salt").orderBy(*ordering)
    w2 = Window.partitionBy(class_col).orderBy(*ordering)
    stage1 = (df.withColumn("_salt", salt_of(salts))
              .withColumn("_rn", F.row_number().over(w1))
              .filter(F.col("_rn") <= cap))
    stage2 = stage1.withColumn("_rn", F.row_number().over(w2)).filter(F.col("_rn") <= cap)
    return stage2.drop("_salt", "_rn")


def benign_cap(df: DataFrame, cap: int, order: Sequence[str], label: str = "label",
               min_rows: int = 10_000) -> DataFrame:
    """The first ``cap`` benign rows in hash order, failing below ``min_rows``.

    The reference takes the first rows in file order, which biases towards
    the first capture; hash order gives an unbiased, reproducible cap.
    ``order[0]`` must be a [0, 1) hash: :func:`hash_prefix` first cuts the
    input to about ``cap`` rows, so the final ordered limit never merges
    ``cap`` rows from every partition in one task.  The count guard runs
    over the capped rows only.
    """
    from vigil.operators.clean import benign_only
    benign = hash_prefix(benign_only(df, label), order[0], cap, materialize=True)
    capped = first_rows(benign, cap, order)
    n = capped.count()
    if n < min_rows:
        raise ValueError(f"not enough benign rows for the isolation forest (seen={n}, "
                         f"need {min_rows})")
    return capped


def first_rows(df: DataFrame, n: int, order: Sequence[str]) -> DataFrame:
    """The first ``n`` rows in ``order``, left in their partitions.

    Only the order columns are ranked (TakeOrdered); the n-th of them then
    filters the rows.  Of rows equal to it in all order columns as many stay
    as fill up to n.
    """
    last = df.select(*order).orderBy(*order).limit(n).orderBy(*[F.desc_nulls_last(c) for c in order]).first()
    if last is None:
        return df
    before, equal = F.lit(False), F.lit(True)
    for c in order:
        v = F.lit(last[c])
        smaller = F.col(c).isNull() & F.lit(last[c] is not None) | F.coalesce(F.col(c) < v, F.lit(False))
        before = before | equal & smaller
        equal = equal & F.col(c).eqNullSafe(v)
    head = df.filter(before)
    return head.unionByName(df.filter(equal).limit(max(0, n - head.count())))


def label_vocab(df: DataFrame, class_col: str) -> DataFrame:
    """M1 / M2 / U7 as a table: class, count, frequency index, alphabetical index.

    Frequency order breaks ties by name, as StringIndexer does.  The global
    windows run on the grouped table, whose size is the number of classes
    (Spark's "no partition defined" notice is expected here).
    """
    counts = df.groupBy(class_col).agg(F.count(F.lit(1)).alias("n"))
    by_freq = Window.orderBy(F.col("n").desc(), F.col(class_col).asc())
    by_name = Window.orderBy(F.col(class_col).asc())
    return counts.select(
        class_col, "n",
        (F.row_number().over(by_freq) - 1).cast("int").alias("freq_index"),
        (F.row_number().over(by_name) - 1).cast("int").alias("alpha_index"))
