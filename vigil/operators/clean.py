"""Projection, cleaning and validation operators."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vigil.functions.columns import f32_finite, finite_or_zero, is_finite
from vigil.schema import BENIGN, FALLBACK_ATTACK, UNKNOWN_ATTACK


def rename_positional(df: DataFrame, prefix: str = "f") -> DataFrame:
    """Give columns the names f0, f1, ... by position."""
    return df.toDF(*[f"{prefix}{i}" for i in range(len(df.columns))])


def tag_source(df: DataFrame, name: str, col: str = "attack_name") -> DataFrame:
    """Constant source tag."""
    return df.withColumn(col, F.lit(name))


def coerce_numeric(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """P10: lenient text -> double; text that is not a number becomes null."""
    return df.withColumns({c: F.expr(f"try_cast(`{c}` AS DOUBLE)") for c in cols})


def fill_features(df: DataFrame, cols: Sequence[str], value: float = 0.0) -> DataFrame:
    """Null and NaN feature -> 0.0 (+-Inf are kept, as ``fillna`` does)."""
    return df.fillna(value, subset=list(cols))


def fill_attack_name(df: DataFrame, col: str = "attack_name") -> DataFrame:
    """Missing attack name -> 'unknown'."""
    return df.fillna(UNKNOWN_ATTACK, subset=[col])


def zero_nonfinite(df: DataFrame, cols: Sequence[str], float32: bool = True) -> DataFrame:
    """P12 (scalar columns): null / NaN / +-Inf -> 0.0.

    With ``float32`` (the reference narrows to float32 first) magnitudes
    beyond the float32 range count as infinite too.
    """
    if not float32:
        return df.withColumns({c: finite_or_zero(c) for c in cols})
    return df.withColumns({c: F.when(f32_finite(c), F.col(c)).otherwise(F.lit(0.0))
                           for c in cols})


def zero_nonfinite_array(arr, float32: bool = True) -> Column:
    """P12 (array column): every non-finite entry -> 0.0."""
    arr = F.col(arr) if isinstance(arr, str) else arr
    test = f32_finite if float32 else is_finite
    return F.transform(arr, lambda x: F.when(test(x.cast("double")), x.cast("double"))
                       .otherwise(F.lit(0.0)))


def all_finite(cols: Sequence[str], float32: bool = True) -> Column:
    """P11 predicate: every feature finite (after float32 narrowing by default)."""
    test = f32_finite if float32 else is_finite
    out = F.lit(True)
    for c in cols:
        out = out & test(c)
    return out


def drop_nonfinite(df: DataFrame, cols: Sequence[str], float32: bool = True) -> DataFrame:
    """Keep rows whose features are all finite."""
    return df.filter(all_finite(cols, float32))


def fill_binary_label(col: str = "label") -> Column:
    """Null binary label counts as attack (1)."""
    return F.coalesce(F.col(col).cast("int"), F.lit(1))


def benign_only(df: DataFrame, label: str = "label") -> DataFrame:
    """Benign rows, where a null label counts as attack."""
    return df.filter(fill_binary_label(label) == 0)


def class_name(label: str = "label", attack: str = "attack_name") -> Column:
    """Training class, 'benign' for label 0 else the attack name."""
    return F.when(F.col(label) == 0, F.lit(BENIGN)).otherwise(F.col(attack))


def true_class(label: str = "label", attack: str = "attack_name",
               unlabelled_as_null: bool = False) -> Column:
    """Scoring-time ground truth with 'attack' fallback.

    ``unlabelled_as_null`` gives null when both label and name are missing,
    instead of the reference's 'attack'.
    """
    base = (F.when(F.col(label) == 0, F.lit(BENIGN))
            .otherwise(F.coalesce(F.col(attack), F.lit(FALLBACK_ATTACK))))
    if unlabelled_as_null:
        return F.when(F.col(label).isNull() & F.col(attack).isNull(),
                      F.lit(None).cast("string")).otherwise(base)
    return base


def features_array(cols: Sequence[str], name: str = "features") -> Column:
    """Pack feature columns into ARRAY<DOUBLE>."""
    return F.array(*[F.col(c).cast("double") for c in cols]).alias(name)


def _source_prefix(source: str, source_col: Column | None) -> Column:
    if source_col is None:
        return F.lit(f"[{source}] ")
    return F.concat(F.lit("["), source_col, F.lit("] "))


def parse_labels(df: DataFrame, col: str = "label_text", out: str = "label",
                 source: str = "labels", source_col: Column | None = None) -> DataFrame:
    """P5 + P6: trim, drop blank, numeric text -> int (truncates toward zero).

    Non-numeric text raises at run time (``raise_error``), naming the source.
    """
    t = F.trim(F.regexp_replace(F.col(col), "^\ufeff", ""))
    num = t.try_cast("double")
    checked = F.when(num.isNull(), F.raise_error(F.concat(
        _source_prefix(source, source_col), F.lit("label is not a number: "), t))
    ).otherwise(num)
    return (df.withColumn(col, t).filter(F.col(col) != "")
            .withColumn(out, checked.cast("int")))


def check_label_domain(df: DataFrame, col: str = "label", allowed=(0, 1),
                       source: str = "labels", source_col: Column | None = None) -> DataFrame:
    """Fail at run time on a label outside ``allowed``, listing the value.

    Expressed as a per-row guard so it needs no extra pass over the data.
    """
    bad = ~F.col(col).isin(*allowed)
    return df.withColumn(col, F.when(bad, F.raise_error(F.concat(
        _source_prefix(source, source_col), F.lit(f"label values outside {set(allowed)}: "),
        F.col(col).cast("string")))).otherwise(F.col(col)))
