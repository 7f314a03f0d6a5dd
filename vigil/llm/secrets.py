"""Secret scans over an incremental blob ledger.

Every version of every path is content-addressed (SHA-256 of the text).  The
ledger is a Parquet table (rule_version, blob, findings); a run scans only the
blobs that have no entry under its rule version, appends them, and joins the
findings back to all paths.  A text that a third of the paths share is scanned
once, and a later run over the same or a grown table scans only what is new.
The rule version is a hash of the rules, so changed rules never serve old findings.
Runs that overlap may append a blob twice; entries fold to one when they are read.

DataFrame functions only.  Spans come from the pieces between the matches
(``split``) and the matches (``regexp_extract_all``): a running sum of both
lengths gives each match its place, counted in code points.

Defined cases: a null text counts as empty and has no finding; repeated rows
each get their row; a null doc_id is passed through; an empty table gives an
empty result.  One failing match never hides a later one of another kind;
within a kind matches are leftmost and do not overlap, and one that fails its
length test is dropped without a retry inside it.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.errors import AnalysisException

from vigil.llm.frames import documents, same
from vigil.session import scratch_path

# fixed values: kind, pattern, group whose length counts, least length, cheap test
RULES = [
    ("assign", r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?"""
               r"""([A-Za-z0-9+/_.=-]+)""", 1, 12, None),
    ("access", r"AKIA[A-Z0-9]+", 0, 18, "AKIA"),
    ("hex", r"[0-9a-f]{16,}+", 0, 16, None),
    ("pem", r"-----BEGIN [A-Z ]*PRIVATE KEY-----", 0, 0, "PRIVATE KEY-----"),
    ("github", r"gh[pousr]_[A-Za-z0-9]{36,}+", 0, 40, "gh"),
    ("jwt", r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}", 0, 0, "eyJ"),
]
BASE_KINDS = 3
# the count goes up when the scan itself changes, not only the rules
RULE_VERSION = "2-" + hashlib.sha256(repr(RULES).encode()).hexdigest()[:16]

_FINDING = T.ArrayType(T.StructType([
    T.StructField("start", T.LongType()), T.StructField("kind", T.IntegerType()),
    T.StructField("end", T.LongType())]))
LEDGER = T.StructType([T.StructField("blob", T.BinaryType()),
                       T.StructField("findings", _FINDING),
                       T.StructField("rule_version", T.StringType())])


def blob_id(text: Column) -> Column:
    return F.unhex(F.sha2(F.coalesce(text, F.lit("")), 256))


def _pieces(text: Column, pattern: str, group: int, hint: str | None) -> Column:
    """(gap before, length, counted length) of each match; the last has no length."""
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    counted = found if group == 0 else F.regexp_extract_all(text, F.lit(pattern), F.lit(group))
    size = lambda xs: F.transform(xs, F.char_length)
    zipped = F.arrays_zip(size(F.split(text, pattern, -1)).alias("gap"), size(found).alias("len"),
                          size(counted).alias("counted"))
    hit = text.rlike(pattern) if hint is None else text.contains(hint) & text.rlike(pattern)
    return F.when(hit, zipped)


def scan(blobs: DataFrame) -> DataFrame:
    """(blob, findings) of every row of ``blobs`` (blob, text); one row per blob is expected."""
    kinds = [F.struct(F.lit(k).alias("kind"),
                      _pieces(F.col("text"), pattern, group, hint).alias("items"))
             for k, (_, pattern, group, _, hint) in enumerate(RULES)]
    # a blob without findings keeps one row: it is known, too
    none = F.struct(F.lit(-1).alias("kind"), F.array(F.struct(
        F.lit(0).alias("gap"), F.lit(0).alias("len"), F.lit(0).alias("counted"))).alias("items"))
    least = F.create_map(*[x for k, r in enumerate(RULES) for x in (F.lit(k), F.lit(r[3]))])
    rows = blobs.select("blob", F.explode(F.array(none, *kinds)).alias("k")) \
        .where("k.items IS NOT NULL") \
        .select("blob", F.col("k.kind").alias("kind"), F.posexplode("k.items").alias("i", "m")) \
        .where("m.len IS NOT NULL")
    so_far = Window.partitionBy("blob", "kind").orderBy("i")
    end = F.sum(F.col("m.gap") + F.col("m.len")).over(so_far)
    spans = rows.withColumn("end", end.cast("long")).select(
        "blob", "kind", F.struct((F.col("end") - F.col("m.len")).alias("start"), "kind", "end")
        .alias("span"), (F.col("m.counted") >= least[F.col("kind")]).alias("ok"))
    return spans.groupBy("blob").agg(F.sort_array(
        F.collect_list(F.when((F.col("kind") >= 0) & F.col("ok"), F.col("span")))).alias("findings"))


def read_ledger(spark: SparkSession, path: str) -> DataFrame:
    try:
        return spark.read.schema(LEDGER).parquet(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], LEDGER)     # no run has written here yet


def update_ledger(docs: DataFrame, path: str, rule_version: str = RULE_VERSION) -> DataFrame:
    """Scan the unseen (blob, rule version) pairs of ``docs``, append them, return the ledger."""
    spark = docs.sparkSession
    seen = read_ledger(spark, path).where(F.col("rule_version") == rule_version).select("blob")
    blobs = documents(docs).select(blob_id(F.col("text")).alias("blob"),
                                   F.coalesce("text", F.lit("")).alias("text"))
    fresh = blobs.dropDuplicates(["blob"]).join(seen, "blob", "left_anti")
    scan(fresh).withColumn("rule_version", F.lit(rule_version)) \
        .write.mode("append").partitionBy("rule_version").parquet(path)
    return read_ledger(spark, path)


def findings(docs: DataFrame, ledger_path: str | None = None,
             rule_version: str = RULE_VERSION) -> DataFrame:
    """(doc_id, findings) of every row: findings are (start, kind, end), kind into RULES."""
    path = ledger_path or scratch_path(docs.sparkSession, "ledger")
    ledger = update_ledger(docs, path, rule_version) \
        .where(F.col("rule_version") == rule_version).select("blob", "findings").dropDuplicates(["blob"])
    paths = documents(docs).select("doc_id", blob_id(F.col("text")).alias("_blob"))
    return paths.join(ledger, same(paths["_blob"], ledger["blob"]), "left") \
        .select("doc_id", "findings")


def _spell(spans: Column) -> Column:
    names = F.array(*[F.lit(r[0]) for r in RULES])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", F.get(names, s["kind"]), s["start"], s["end"])), ",")


def secret_digest(docs: DataFrame, ledger_path: str | None = None) -> DataFrame:
    """(doc_id, n_assign, n_access, n_hex, base_sha256, spans) of every document."""
    f = F.col("findings")
    base = F.filter(f, lambda s: s["kind"] < BASE_KINDS)
    of_kind = lambda k: F.filter(f, lambda s: s["kind"] == k)
    counts = [F.size(of_kind(k)).cast("long").alias(f"n_{RULES[k][0]}") for k in range(BASE_KINDS)]
    return findings(docs, ledger_path).select(
        "doc_id", *counts, F.sha2(_spell(base), 256).alias("base_sha256"),
        _spell(f).alias("spans"))
