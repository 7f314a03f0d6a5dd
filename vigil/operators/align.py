"""Positional alignment and tagged union.

Spark rows have no order, but file rows do.  A row's position inside its
capture is the number of rows in earlier (file, block) splits plus its
ordinal inside its own split.  The ordinal comes from the row id attached
on the scan stage (ids are consecutive inside a split); the per-split
counts are a small table (one row per split) whose running sum is a
window partitioned by capture.  Feature row i then meets label row i at
(capture, pos).  Binary labels are packed to a bit a row (a run of equal labels
to less) and broadcast while their counted bytes are bounded, so feature columns
are not shuffled; beyond that, and for other labels, rows join on (capture, pos), an
equi-join on a unique key, so no key is hot however large one capture is.

The counts and the rows come from two jobs, and Spark cuts a scan into splits
anew for each.  The split settings are therefore pinned before the count
(:func:`pin_splits`), and every row proves its place: a row whose split was not
counted, or whose ordinal lies outside the counted rows of its split, fails the
job.  Any other cut shifts some row out of its counted range, so a changed plan
can never lose or misplace rows silently.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType

# Packed labels: positions a chunk, and the bytes up to which they are broadcast.
CHUNK_BITS, LABEL_BYTES_MAX = 12, 32 << 20
# Above this many splits the offset table is joined by shuffle, not broadcast.
BROADCAST_SPLITS_MAX = 200_000


def frozen(df: DataFrame) -> DataFrame:
    """Materialise a small derived table with a reliable checkpoint.

    Not ``persist()``: Spark's cache matches by logical plan, so a cached
    split table could be served to a later read of the same path made with
    other split settings or after the files changed, silently misaligning
    rows.  A checkpoint is tied to this computation, lives in the shared
    ``spark.checkpoint.dir`` and survives executor loss.
    """
    from vigil.session import checkpoint_root
    checkpoint_root(df.sparkSession)
    return df.checkpoint(eager=True)


def pin_splits(spark) -> None:
    """Keep the session's scans cut alike while executors come and go.

    Spark derives the split size from the cores it sees unless the least number
    of splits is set; the other split settings only change when a job sets them.
    """
    key = "spark.sql.files.minPartitionNum"
    if spark.conf.get(key, None) is None:
        spark.conf.set(key, str(max(1, spark.sparkContext.defaultParallelism)))


def file_order(col: str) -> list:
    """Order of part files: by folder, part number (not its text), then name."""
    path = F.col(col)
    number = F.regexp_extract(path, r"/part-(\d+)[^/]*$", 1).try_cast("bigint")
    return [F.regexp_extract(path, r"^(.*)/[^/]*$", 1), number.asc_nulls_first(), path]


def split_offsets(df: DataFrame, capture: str = "capture") -> DataFrame:
    """Per (capture, file, block) split: first row id, rows, rows before it.

    The running sum is a window over split rows (input bytes / split size of
    them), partitioned by capture; with a single constant capture Spark
    notes that the window has no partition key, which is fine at this size.
    """
    blocks = df.groupBy(capture, "_file", "_block").agg(
        F.min("_rid").alias("_rid0"), F.count(F.lit(1)).alias("_n"))
    w = (Window.partitionBy(capture).orderBy(*file_order("_file"), "_block")
         .rowsBetween(Window.unboundedPreceding, -1))
    return blocks.withColumn("_before", F.coalesce(F.sum("_n").over(w), F.lit(0)))


def add_positions(df: DataFrame, capture: str = "capture",
                  offsets: DataFrame | None = None, n_splits: int | None = None) -> DataFrame:
    """0-based row position per capture, following file name then byte order.

    The split table has one row per file split (input bytes / split size);
    it is broadcast when its counted size is under BROADCAST_SPLITS_MAX and
    shuffle-joined otherwise.
    """
    pin_splits(df.sparkSession)
    if offsets is None:
        offsets = frozen(split_offsets(df, capture))
    if n_splits is None:
        n_splits = offsets.count()
    side = offsets.select(F.col(capture).alias("_c"), F.col("_file").alias("_f"),
                          F.col("_block").alias("_b"), "_rid0", "_n", "_before")
    if n_splits <= BROADCAST_SPLITS_MAX:
        side = F.broadcast(side)
    out = df.join(side, F.col(capture).eqNullSafe(F.col("_c")) & (F.col("_file") == F.col("_f"))
                  & (F.col("_block") == F.col("_b")), "left")
    ordinal = F.col("_rid") - F.col("_rid0")
    counted = F.coalesce((ordinal >= 0) & (ordinal < F.col("_n")), F.lit(False))
    problem = F.concat(F.lit("split plan changed between count and read: "), F.col("_file"),
                       F.lit(" at byte "), F.col("_block").cast("string"))
    pos = F.when(counted, F.col("_before") + ordinal) \
        .otherwise(F.raise_error(problem).cast("bigint"))
    # the filter keeps the proof in the plan when a query prunes ``pos``
    return out.withColumn("pos", pos).where(F.col("pos") >= 0).drop(
        "_file", "_block", "_rid", "_rid0", "_before", "_n", "_c", "_f", "_b")


def capture_counts(offsets: DataFrame, capture: str = "capture") -> dict:
    """(rows, splits) per capture from the split table (one small aggregate)."""
    return {r[0]: (r[1], r[2]) for r in offsets.groupBy(capture).agg(
        F.sum("_n").alias("n"), F.count(F.lit(1)).alias("s")).collect()}


def positional_join(features: DataFrame, labels: DataFrame, capture: str = "capture",
                    check_counts: bool = True,
                    feature_counts: DataFrame | None = None) -> DataFrame:
    """J1 + P22: feature row i <-> label row i within each capture.

    Both inputs must carry the scan-stage position columns
    (``sources.capture.file_position_columns``) and a capture column.
    Raises when a capture's feature and label counts differ.
    ``feature_counts`` is an optional lighter read of the same feature files
    (same splits, so the same row ids) used only to count rows per split.
    """
    pin_splits(features.sparkSession)
    # the split tables are tiny (one row per file split); freeze them for
    # the count check and the offset joins instead of scanning twice more
    xo = frozen(split_offsets(feature_counts if feature_counts is not None else features,
                              capture))
    yo = frozen(split_offsets(labels, capture))
    nx, ny = capture_counts(xo, capture), capture_counts(yo, capture)
    if check_counts:
        for cap in sorted(set(nx) | set(ny)):
            a, b = nx.get(cap, (0, 0))[0], ny.get(cap, (0, 0))[0]
            if a > b:
                raise ValueError(f"[{cap}] more feature rows than labels "
                                 f"(features={a}, labels={b})")
            if b > a:
                raise ValueError(f"[{cap}] more labels than feature rows "
                                 f"(features={a}, labels={b})")
    x = add_positions(features, capture, xo, sum(v[1] for v in nx.values()))
    y = add_positions(labels, capture, yo, sum(v[1] for v in ny.values()))
    payload = [f for f in y.schema.fields if f.name not in (capture, "pos")]
    if len(payload) == 1 and isinstance(payload[0].dataType, IntegralType):
        bits = packed_labels(y, payload[0].name, capture)
        if bits is not None:
            return _with_bits(x, bits, payload[0], capture)
    return x.join(y, [capture, "pos"])


def packed_labels(y: DataFrame, label: str, capture: str = "capture",
                  max_bytes: int | None = None) -> DataFrame | None:
    """(capture, chunk, one, words): the 0/1 labels of ``CHUNK`` positions as bits.

    64 neighbours become one word inside the task that reads them.  A chunk of one
    single run keeps its label in ``one`` and no words, so long runs cost a row a
    chunk.  None if a label is null or not 0 or 1, or if the counted bytes are over
    ``max_bytes``: then the labels have to be joined row by row.
    """
    word = F.shiftright("pos", 6)
    words = y.groupBy(capture, word.alias("_w")).agg(
        F.expr(f"bit_or(shiftleft(cast(`{label}` AS bigint), cast(pos & 63 AS int)))").alias("_bits"),
        F.min(label).alias("_lo"), F.max(label).alias("_hi"), F.count(label).alias("_n"), F.count(F.lit(1)).alias("_all"))
    chunks = frozen(words.groupBy(capture, F.shiftright("_w", CHUNK_BITS - 6).alias("_chunk")).agg(
        F.sort_array(F.collect_list(F.struct("_w", "_bits"))).alias("_s"),      # at most CHUNK / 64
        F.min("_lo").alias("_lo"), F.max("_hi").alias("_hi"), F.sum("_n").alias("_n"), F.sum("_all").alias("_all"))
        .select(F.col(capture).alias("_c"), "_chunk", "_lo", "_hi", "_n", "_all",
                F.when(F.col("_lo") == F.col("_hi"), F.col("_lo")).cast("int").alias("_one"),
                F.when(F.col("_lo") != F.col("_hi"), F.transform("_s", lambda v: v["_bits"])).alias("_words")))
    size = chunks.agg(F.min("_lo").alias("lo"), F.max("_hi").alias("hi"),
                      F.sum(F.col("_all") - F.col("_n")).alias("nulls"),
                      F.sum(64 + F.length("_c") + 8 * F.coalesce(F.size("_words"), F.lit(0))).alias("bytes")).first()
    if size["bytes"] is None or size["nulls"] or size["lo"] < 0 or size["hi"] > 1 \
            or size["bytes"] > (LABEL_BYTES_MAX if max_bytes is None else max_bytes):
        return None
    return chunks.select("_c", "_chunk", "_one", "_words", "_all")


def _with_bits(x: DataFrame, bits: DataFrame, label, capture: str) -> DataFrame:
    """Each feature row with its bit: no feature column is shuffled."""
    met = x.join(F.broadcast(bits), (F.col(capture) == F.col("_c"))
                 & (F.shiftright("pos", CHUNK_BITS) == F.col("_chunk")), "left")
    at = F.col("pos").bitwiseAND(F.lit((1 << CHUNK_BITS) - 1)).cast("int")
    bit = F.expr(f"shiftright(get(_words, shiftright(cast(pos & {(1 << CHUNK_BITS) - 1} AS int), 6)),"
                 " cast(pos & 63 AS int)) & 1")
    known = F.coalesce(at < F.col("_all"), F.lit(False))
    lost = F.concat(F.lit("no label for row "), F.col("pos").cast("string"), F.lit(" of "),
                    F.coalesce(F.col(capture).cast("string"), F.lit("null")))
    value = F.when(known, F.coalesce(F.col("_one").cast("bigint"), bit)).otherwise(F.raise_error(lost).cast("bigint"))
    rest = [c for c in x.columns if c not in (capture, "pos")]
    # the filter keeps the proof in the plan when a query prunes the label
    return met.withColumn("_label", value).where(F.col("_label") >= 0).select(
        capture, "pos", *rest, F.col("_label").cast(label.dataType).alias(label.name))


def union_tagged(parts: list[tuple[str, DataFrame]], col: str = "attack_name") -> DataFrame:
    """U1 + P4: tag each part with its source name and UNION ALL by name."""
    tagged = [df.withColumn(col, F.lit(name)) for name, df in parts]
    return reduce(lambda a, b: a.unionByName(b), tagged)
