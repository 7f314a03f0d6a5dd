"""Scalar column functions used across operators.

Nothing here leaves the JVM: no Python UDF is involved, so every helper
composes into the surrounding whole-stage-codegen span.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

_TWO_31 = 2147483648
# Largest finite float32; the reference narrows features to float32 before
# its finiteness test, so larger magnitudes count as non-finite there.
FLOAT32_MAX = 3.4028234663852886e38


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def is_finite(c) -> Column:
    """True for a real, finite number; False for null, NaN and +-Inf."""
    c = _c(c)
    return F.coalesce(~F.isnan(c) & (F.abs(c) < F.lit(float("inf"))), F.lit(False))


def f32_finite(c) -> Column:
    """Finite after narrowing to float32 (|x| <= FLOAT32_MAX, not NaN)."""
    c = _c(c)
    return F.coalesce(~F.isnan(c) & (F.abs(c) <= F.lit(FLOAT32_MAX)), F.lit(False))


def finite_or_zero(c) -> Column:
    """Scoring-time clean-up: null / NaN / +-Inf -> 0.0 (scalar form)."""
    c = _c(c)
    return F.when(is_finite(c), c).otherwise(F.lit(0.0))


def lcg_hash(key, seed: int = 0) -> Column:
    """Deterministic integer hash in [0, 2^31): (k * 1103515245 + 12345) mod 2^31.

    ``k = (key + seed) mod 2^31`` keeps the product inside BIGINT for any key,
    so the same integer comes out of Spark and of any SQL engine.
    """
    k = F.pmod(_c(key).cast("bigint") + F.lit(seed), F.lit(_TWO_31))
    return F.pmod(k * F.lit(1103515245) + F.lit(12345), F.lit(_TWO_31))


def hash_uniform(key, seed: int = 0) -> Column:
    """lcg_hash scaled to [0, 1)."""
    return lcg_hash(key, seed) / F.lit(float(_TWO_31))


def softmax(arr, k: int, scale: float = 1.0) -> Column:
    """Softmax over the first ``k`` entries of a numeric array column.

    ``k`` is known when the plan is built, so the function is spelled out
    element by element: plain expressions stay inside whole-stage codegen
    (lambda functions would not), and common sub-expressions are shared.
    The largest entry is subtracted first, so no scale overflows.  The sum
    runs left to right.  The array must hold at least ``k`` entries.
    """
    a = _c(arr)
    xs = [F.lit(float(scale)) * F.get(a, i).cast("double") for i in range(k)]
    top = F.greatest(*xs) if k > 1 else xs[0]
    ex = [F.exp(x - top) for x in xs]
    total = ex[0]
    for e in ex[1:]:
        total = total + e
    return F.array(*[e / total for e in ex])


def fold_scores(arr, k: int, width: int) -> Column:
    """``k`` scores from an array of ``width`` entries: score j sums the entries i with i mod k = j.

    The sums are spelled out, from the left, so they stay in whole-stage codegen.
    """
    a = _c(arr)

    def one(j):
        total = F.lit(0.0)
        for i in range(j, width, k):
            total = total + F.get(a, i).cast("double")
        return total
    return F.array(*[one(j) for j in range(k)])


def argmax(arr) -> Column:
    """0-based index of the largest entry (first one on ties)."""
    arr = _c(arr)
    return (F.array_position(arr, F.array_max(arr)) - F.lit(1)).cast("int")


def class_lookup(vocab: Sequence[str], idx, missing: str | None = None) -> Column:
    """Class index -> name; out-of-range or null index -> ``missing``.

    ``get`` is 0-based and gives null out of range (``element_at`` would raise
    under ANSI), which covers the model's extra 'unseen' class.
    """
    names = F.array(*[F.lit(v) for v in vocab])
    out = F.get(names, _c(idx).cast("int"))
    return F.coalesce(out, F.lit(missing)) if missing is not None else out


def event_key(topic, partition, offset) -> Column:
    """Stable event id ``topic:partition:offset``."""
    return F.concat_ws(":", _c(topic), _c(partition).cast("string"),
                       _c(offset).cast("string"))


def to_day(ts) -> Column:
    """Daily bucket name ``yyyy.MM.dd``."""
    return F.date_format(_c(ts), "yyyy.MM.dd")
