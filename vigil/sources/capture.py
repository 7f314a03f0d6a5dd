"""Capture files.

Capture feature files are headerless CSV with N numeric columns, or N+1
when a leading row index was saved with them.  The width is read from the
first line only; rows are parsed by Spark's CSV reader under a declared
schema (no inference pass), PERMISSIVE, so a bad number becomes null and is
handled by the cleaning operators.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vigil.schema import feature_names, feature_schema, labelled_schema

_FEATURE_RE = re.compile(r"^f(\d+)$")


def first_line(spark: SparkSession, path: str, source: str | None = None) -> str:
    """S11 + peek: the first line of a file or folder; a clear error if missing."""
    try:
        row = spark.read.text(path).limit(1).first()
    except Exception as e:  # noqa: BLE001 - Spark's PATH_NOT_FOUND and friends
        raise FileNotFoundError(f"[{source or path}] input not found: {path}") from e
    if row is None:
        raise ValueError(f"[{source or path}] input is empty: {path}")
    return row[0].lstrip("\ufeff")


def probe(spark: SparkSession, path: str, source: str | None = None) -> tuple[str, str, bool]:
    """First line of a file set, and how to recognise its rows in a shared scan.

    Returns (first line, match key, exact): the key is spelled the way
    ``_metadata.file_path`` spells paths (taken from that very column), so
    rows of this source are those whose file path equals the key (a single
    file) or starts with it (a folder).
    """
    from urllib.parse import unquote
    try:
        row = (spark.read.text(path)
               .select("value", F.col("_metadata.file_path").alias("f")).limit(1).first())
    except Exception as e:  # noqa: BLE001 - Spark's PATH_NOT_FOUND and friends
        raise FileNotFoundError(f"[{source or path}] input not found: {path}") from e
    if row is None:
        raise ValueError(f"[{source or path}] input is empty: {path}")
    first = row["f"]
    leaf = unquote(first.rsplit("/", 1)[-1])
    if unquote(path.rstrip("/")).rsplit("/", 1)[-1] == leaf:
        return row["value"].lstrip("\ufeff"), first, True
    return row["value"].lstrip("\ufeff"), _folder_key(path, first), False


def _folder_key(path: str, first: str) -> str:
    """The given folder as it is spelled in the file paths Spark reports.

    Not the first file's own folder: the files may lie in sub-folders.
    """
    from urllib.parse import unquote
    want = [unquote(c) for c in path.split("://")[-1].split("/") if c and not c.endswith(":")]
    have = first.split("/")
    for i in range(len(have) - len(want)):
        if [unquote(c) for c in have[i:i + len(want)]] == want:
            return "/".join(have[:i + len(want)]) + "/"
    return first.rsplit("/", 1)[0] + "/"


def source_column(keys: list[tuple[str, str, bool]]):
    """Row -> source name, from (name, key, exact) triples made by :func:`probe`."""
    fp = F.col("_metadata.file_path")
    out = None
    # exact files first, then longer (more specific) folder keys, so a folder
    # nested in another capture's folder keeps its own rows
    for name, key, exact in sorted(keys, key=lambda k: (not k[2], -len(k[1]))):
        cond = (fp == F.lit(key)) if exact else fp.startswith(key)
        out = F.when(cond, F.lit(name)) if out is None else out.when(cond, F.lit(name))
    return out.otherwise(F.raise_error(F.concat(F.lit("file of no capture: "), fp)).cast("string"))


def has_glob(path: str) -> bool:
    return any(ch in path for ch in "*?[{")


def csv_width(spark: SparkSession, path: str, source: str | None = None) -> int:
    return len(first_line(spark, path, source).split(","))


def _capture_schema(spark: SparkSession, path: str, n_features: int, source: str | None,
                    width: int | None = None):
    width = width if width is not None else csv_width(spark, path, source)
    if width == n_features:
        return width, feature_schema(n_features)
    if width == n_features + 1:
        return width, feature_schema(n_features, prefix_index=True)
    raise ValueError(f"[{source or path}] unexpected column count: {width} "
                     f"(expected {n_features} or {n_features + 1})")


def malformed_guard(schema, source):
    """Filter condition that fails the job on a malformed row (P3 per row).

    The error text also names every parsed column, so whatever the query
    keeps, the scan still parses them all: Spark flags malformed rows only
    in the columns it parses, and refuses a scan that reads nothing but the
    corrupt-record column.  The text is built only for a bad row.
    """
    bad = F.col("_corrupt_record")
    parsed = [F.col(c) for c in schema.fieldNames() if c != "_corrupt_record"]
    message = F.concat(F.lit("["), source, F.lit("] malformed row: "), bad,
                       F.lit(" (parsed as "), F.to_json(F.array(*parsed)), F.lit(")"))
    return F.when(bad.isNotNull(), F.raise_error(message)).otherwise(F.lit(True))


def malformed_rows(spark: SparkSession, path: str, n_features: int = 115,
                   source: str | None = None) -> DataFrame:
    """(source, line) of rows with another width or a non-numeric field.

    Every column is parsed (Spark only flags malformed rows in the columns
    it parses), so this is a full pass over the file.
    """
    _, schema = _capture_schema(spark, path, n_features, source)
    schema = schema.add("_corrupt_record", "string")
    df = (spark.read.schema(schema).option("mode", "PERMISSIVE")
          .option("columnNameOfCorruptRecord", "_corrupt_record").csv(path))
    bad = df.filter(F.col("_corrupt_record").isNotNull())
    every = [F.col(c) for c in schema.fieldNames()]
    return bad.select(F.lit(source or path).alias("source"),
                      F.col("_corrupt_record").alias("line"),
                      F.array(*every[:-1]).alias("_parsed"))


def raise_if_malformed(bad: DataFrame) -> None:
    """P3 per row: one job over all given captures; the first bad line is quoted."""
    hit = bad.limit(1).collect()  # keep _parsed: it makes Spark parse every column
    if hit:
        raise ValueError(f"[{hit[0]['source']}] malformed row: {hit[0]['line']!r}")


def validate_rows(spark: SparkSession, path: str, n_features: int = 115,
                  source: str | None = None) -> None:
    raise_if_malformed(malformed_rows(spark, path, n_features, source))


def read_features(spark: SparkSession, path: str, n_features: int = 115,
                  source: str | None = None, strict: bool = False,
                  width: int | None = None) -> DataFrame:
    """S2 + P1 + P2 + P3: headerless capture -> f0..f{n-1} DOUBLE.

    Width n is taken as is, n+1 drops the leading index column (pruned from
    the scan), anything else raises naming the source.  With ``strict`` a
    row of another width or with a non-numeric field fails the job that
    reads it (a ``raise_error`` filter fused into the scan stage, no extra
    pass); the result must then be used with all its feature columns, since
    Spark only checks the columns it parses.  Otherwise such rows are read
    leniently (missing or bad fields become null).
    """
    width, schema = _capture_schema(spark, path, n_features, source, width)
    if strict:
        schema = schema.add("_corrupt_record", "string")
    df = (spark.read.schema(schema).option("header", "false").option("mode", "PERMISSIVE")
          .option("columnNameOfCorruptRecord", "_corrupt_record").csv(path))
    if strict:
        df = df.filter(malformed_guard(schema, F.lit(source or path))).drop("_corrupt_record")
    return df.drop("_index") if width == n_features + 1 else df


def read_features_inferred(spark: SparkSession, path: str) -> DataFrame:
    """Width from the first row, all columns f0.. as DOUBLE."""
    n = csv_width(spark, path)
    return spark.read.schema(feature_schema(n)).csv(path)


def read_labelled(spark: SparkSession, path: str, n_features: int = 115,
                  label: str = "label") -> DataFrame:
    """Labelled CSV with header under the declared schema."""
    return (spark.read.option("header", "true").option("mode", "PERMISSIVE")
            .schema(labelled_schema(n_features, label)).csv(path))


def discover_features(columns: list[str], n_expected: int | None = None,
                      required: tuple[str, ...] = ("label", "attack_name")) -> list[str]:
    """Feature columns by name ``f<digits>`` in numeric order, with checks."""
    cols = [c.strip() for c in columns]
    feats = sorted((c for c in cols if _FEATURE_RE.match(c)),
                   key=lambda c: int(_FEATURE_RE.match(c).group(1)))
    if not feats:
        raise ValueError("no feature columns f0..fN found")
    for r in required:
        if r not in cols:
            raise ValueError(f"column '{r}' not found")
    if n_expected is not None and len(feats) != n_expected:
        raise ValueError(f"expected {n_expected} feature columns, got {len(feats)}")
    if feats != feature_names(len(feats)):
        raise ValueError("feature columns are not contiguous f0..fN")
    return feats


def file_position_columns(df: DataFrame) -> DataFrame:
    """Attach (file, block, row id) on the scan stage, before any shuffle."""
    return df.select("*", F.col("_metadata.file_path").alias("_file"),
                     F.col("_metadata.file_block_start").alias("_block"),
                     F.monotonically_increasing_id().alias("_rid"))
