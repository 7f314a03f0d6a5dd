"""Line dedup with range-partitioned line hashes and compressed keep bitmaps.

Every line of at least ``min_chars`` code points (white space at the ends and
the case of A-Z do not count) becomes a 128-bit hash with its document and
position, written once to the shared folder: the hot keys, the range bounds and
the shuffle all read that table.  The hashes are range-partitioned and sorted by (hash, document,
position); a window over that order streams each key's first document and drops
the key's lines in all others.  Only the dropped positions leave that shuffle:
per document they are folded to runs (start, length), a run-length compressed
keep bitmap, and :func:`apply_bitmaps` cuts the texts with it.

Hot keys: keys that hold more than half a partition's share of the lines are
found with ``freqItems`` (a bounded list that misses none); only for them the
partitioning adds a slot taken from the document, and the slots' first
documents, pre-aggregated, meet in a small table.

DataFrame functions only.  Defined cases: a null or empty text is one empty
line; line keys shorter than ``min_chars`` stay everywhere; repeated lines stay
in the first document; rows that share a doc_id count as one document (each is
cut by its own lines); a null doc_id sorts first, like an id of its own.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vigil.llm.frames import documents, freeze, parallelism, same

MIN_CHARS = 10
# fixed values: the ASCII white space that does not count at the ends of a line
BLANKS = " \t\n\x0b\x0c\r"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def lines_of(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def line_key(line: Column) -> Column:
    k = F.btrim(line, F.lit(BLANKS))
    ascii_only = F.octet_length(k) == F.char_length(k)
    return F.when(ascii_only, F.lower(k)).otherwise(F.translate(k, _UPPER, _LOWER))


def _rows(docs: DataFrame, min_chars: int) -> DataFrame:
    """(doc_id, fp, pos, h1, h2) of every line long enough to count."""
    lines = documents(docs).select(
        "doc_id", F.xxhash64("text").alias("fp"),
        F.posexplode(lines_of(F.col("text"))).alias("pos", "line"))
    # trimming and lower-casing never lengthen a line
    keys = lines.where(F.octet_length("line") >= min_chars).select(
        "doc_id", "fp", "pos", line_key(F.col("line")).alias("k"))
    return keys.where(F.char_length("k") >= min_chars).select(
        "doc_id", "fp", "pos", F.xxhash64("k").alias("h1"),
        F.xxhash64(F.lit(1), "k").alias("h2"))


def hot_keys(rows: DataFrame, parts: int) -> list[int]:
    """Every h1 that holds over 1 / (2 parts) of the rows, and at most 2 parts others."""
    support = max(1e-4, 1 / (2 * parts))
    return rows.select("h1").stat.freqItems(["h1"], support).first()[0] or []


def keep_bitmaps(docs: DataFrame, min_chars: int = MIN_CHARS) -> DataFrame:
    """(doc_id, fp, runs, n_dropped): the dropped lines of each cut text as runs.

    ``fp`` is xxhash64 of the text, ``runs`` an array of (start, len) in line
    positions, ascending and disjoint.  Texts that lose nothing have no row.
    """
    rows = freeze(_rows(docs, min_chars), "line_keys")
    spark, parts = rows.sparkSession, parallelism(rows)
    hot = F.broadcast(spark.createDataFrame([(h, True) for h in hot_keys(rows, parts)],
                                            "h1 long, hot boolean"))
    slot = F.when(F.col("hot"), F.pmod(F.xxhash64("doc_id"), F.lit(parts)) + 1).otherwise(0)
    dealt = rows.join(hot, "h1", "left").withColumn("slot", slot.cast("int")) \
        .repartitionByRange(parts, "h1", "h2", "slot")
    order = Window.partitionBy("h1", "h2", "slot").orderBy(F.asc_nulls_first("doc_id"), "pos")
    streamed = dealt.withColumn("holder", F.first(F.struct("doc_id")).over(order))
    # slots of a hot key: the first document over all of them
    heads = rows.join(hot, "h1").groupBy("h1", "h2").agg(F.min(F.struct("doc_id")).alias("head"))
    first = F.coalesce("head", "holder")
    dropped = streamed.join(F.broadcast(heads), ["h1", "h2"], "left") \
        .where(~same(F.col("doc_id"), first["doc_id"])).select("doc_id", "fp", "pos")
    # positions of a document become runs: pos - rank is constant within a run
    by_doc = Window.partitionBy("doc_id", "fp").orderBy("pos")
    runs = dropped.repartition(parts, "doc_id", "fp").dropDuplicates() \
        .withColumn("run", F.col("pos") - F.row_number().over(by_doc)) \
        .groupBy("doc_id", "fp", "run").agg(F.min("pos").alias("start"),
                                            F.count("*").cast("int").alias("len"))
    return runs.groupBy("doc_id", "fp").agg(
        F.sort_array(F.collect_list(F.struct("start", "len"))).alias("runs"),
        F.sum("len").cast("long").alias("n_dropped"))


def _keep_flags(runs: Column) -> Column:
    """The bitmap as flags, up to the last dropped line."""
    before = lambda i: F.when(i > 0, F.get(runs, i - 1)["start"] + F.get(runs, i - 1)["len"]) \
        .otherwise(0)
    return F.flatten(F.transform(runs, lambda r, i: F.concat(
        F.array_repeat(F.lit(True), r["start"] - before(i)),
        F.array_repeat(F.lit(False), r["len"]))))


def apply_bitmaps(docs: DataFrame, bitmaps: DataFrame) -> DataFrame:
    """``docs`` with added columns (lines, kept, n_dropped); the rows are all kept."""
    b = bitmaps.select(F.col("doc_id").alias("_id"), F.col("fp").alias("_fp"),
                       F.col("runs").alias("_runs"), F.col("n_dropped").alias("_n"))
    id_, fp = docs["doc_id"].cast("long"), F.xxhash64(docs["text"].cast("string"))
    both = docs.join(b.hint("shuffle_hash"), same(id_, b["_id"]) & (fp == b["_fp"]), "left")
    lines = lines_of(F.col("text").cast("string"))
    pairs = F.arrays_zip(lines.alias("l"), _keep_flags(F.col("_runs")).alias("f"))
    cut = F.transform(F.filter(pairs, lambda z: F.coalesce(z["f"], F.lit(True))), lambda z: z["l"])
    return both.select(
        *[docs[c] for c in docs.columns],
        F.size(lines).cast("long").alias("_n_lines"),
        F.coalesce("_n", F.lit(0)).cast("long").alias("_n_dropped"),
        F.when(F.col("_runs").isNull(), F.coalesce(F.col("text").cast("string"), F.lit("")))
        .otherwise(F.array_join(cut, "\n")).alias("_kept"))


def line_digest(docs: DataFrame, min_chars: int = MIN_CHARS) -> DataFrame:
    """(doc_id, n_lines, n_dropped, kept_sha256) of every document."""
    src = documents(docs)
    out = apply_bitmaps(src, keep_bitmaps(src, min_chars))
    return out.select("doc_id", F.col("_n_lines").alias("n_lines"),
                      F.col("_n_dropped").alias("n_dropped"),
                      F.sha2("_kept", 256).alias("kept_sha256"))


def dedup_lines(docs: DataFrame, min_chars: int = MIN_CHARS, keep_emptied: bool = True) -> DataFrame:
    """``docs`` with ``text`` (and ``n_chars``, where there is one) cut to the kept lines.

    Without ``keep_emptied`` documents that lose lines and keep nothing but white space go;
    texts that were blank before stay.  The other columns may have any names.
    """
    cut = ("text", "n_chars")
    rest = [c for c in docs.columns if c not in cut]
    # under one name, so that no column of the input meets one of the operator's
    held = docs.select("doc_id", "text", F.struct(*[F.col(f"`{c}`") for c in rest]).alias("_rest"))
    out = apply_bitmaps(held, keep_bitmaps(docs, min_chars))
    if not keep_emptied:
        out = out.where((F.col("_n_dropped") == 0) | (F.btrim("_kept", F.lit(BLANKS)) != ""))
    new = {"text": F.col("_kept"), "n_chars": F.char_length("_kept").cast("long")}
    return out.select(*[new[c].alias(c) if c in cut else F.col("_rest").getField(c).alias(c)
                        for c in docs.columns])
