"""Registered queries over capture / label files that Spark derives from the
driver's tables (written under the shared checkpoint folder, in row order).

* ``positional_label_join``: events -> feature CSV (event_id, value) and a
  layout-A label file with a BOM and blank lines; J1 must restore the pairs.
* ``label_parse_guard``: labels.quality as layout A, labels.toxic as layout B.
* ``build_dataset`` / ``source_counts``: events split into one capture per
  event type (one with a leading index column, two with layout-B labels),
  built into one labelled table, written as Parquet and read back.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vigil.operators.align import positional_join
from vigil.plans.build import build_labelled_table, write_counted, write_parquet
from vigil.session import scratch_path
from vigil.sources.capture import file_position_columns, read_features
from vigil.sources.labels import read_labels
from vigil.sources.tables import decode_props, read_table

BLANK_EVERY = 50


def _ordered(df: DataFrame, order: str, by: str | None) -> DataFrame:
    """Rows range-partitioned and sorted so part files in name order (inside
    each ``by`` folder) hold the rows in ``order``; the sort also satisfies the
    writer's per-folder ordering, so no second sort is added."""
    keys = ([by] if by else []) + [order]
    return df.repartitionByRange(*keys).sortWithinPartitions(*keys)


def _write(df: DataFrame, fmt: str, path: str, by: str | None, header: bool = False) -> None:
    w = df.write.mode("overwrite").option("header", str(header).lower())
    if by:
        w = w.partitionBy(by)
    w.format(fmt).save(path)


def write_ordered_csv(df: DataFrame, order: str, cols: list[str], path: str,
                      by: str | None = None) -> None:
    """Headerless CSV whose part files, in name order, hold rows in ``order``
    (one folder ``by=<value>`` per group when ``by`` is given)."""
    _write(_ordered(df, order, by).select(*cols, *([by] if by else [])), "csv", path, by)


def write_layout_a(df: DataFrame, order: str, label: str, path: str,
                   bom_first: bool = True, blank_every: int = BLANK_EVERY,
                   by: str | None = None) -> None:
    """Label file, layout A: one value per line, BOM on each group's first,
    blank lines after every ``blank_every``-th row (all derived from the rows)."""
    g = [F.col(by)] if by else []
    base = df.select(*g, F.col(order).cast("bigint").alias("_o"),
                     F.col(label).cast("string").alias("value"))
    firsts = base.groupBy(*g).agg(F.min("_o").alias("_first"))  # one row per group
    if by:
        base = base.join(firsts, by)   # one row per group; AQE sizes the join
    else:
        base = base.withColumn("_first", F.lit(firsts.first()[0]))
    text = F.when(F.lit(bom_first) & (F.col("_o") == F.col("_first")),
                  F.concat(F.lit("\ufeff"), F.col("value"))).otherwise(F.col("value"))
    rows = base.select(*g, (F.col("_o") * 2).alias("_k"), text.alias("value"))
    blanks = base.filter(F.col("_o") % blank_every == 0).select(
        *g, (F.col("_o") * 2 + 1).alias("_k"), F.lit("   ").alias("value"))
    out = _ordered(rows.unionByName(blanks), "_k", by).select("value", *([by] if by else []))
    _write(out, "text", path, by)


def write_layout_b(df: DataFrame, order: str, label: str, path: str,
                   by: str | None = None) -> None:
    """Label file, layout B: header ``"",x`` in every part, index then label."""
    out = _ordered(df, order, by).select(F.col(order).cast("string").alias(""),
                                         F.col(label).cast("int").alias("x"),
                                         *([by] if by else []))
    _write(out, "csv", path, by, header=True)


def q_positional_label_join(spark, sf_dir):
    base = scratch_path(spark, "positional_label_join")
    ev = read_table(spark, sf_dir, "events").withColumn(
        "label", (F.col("event_type") == "error").cast("int"))
    write_ordered_csv(ev, "event_id", ["event_id", "value"], f"{base}/x")
    write_layout_a(ev, "event_id", "label", f"{base}/y")
    x = file_position_columns(read_features(spark, f"{base}/x", 2, "events"))
    y = read_labels(spark, f"{base}/y", "events")
    j = positional_join(x.withColumn("capture", F.lit("events")),
                        y.withColumn("capture", F.lit("events")), "capture")
    return j.select("pos", F.col("f0").cast("bigint").alias("event_id"),
                    F.col("f1").alias("value"), "label")


def q_label_parse_guard(spark, sf_dir):
    base = scratch_path(spark, "label_parse_guard")
    lab = read_table(spark, sf_dir, "labels")
    write_layout_a(lab, "doc_id", "quality", f"{base}/a")
    write_layout_b(lab, "doc_id", "toxic", f"{base}/b")
    from vigil.operators.align import add_positions
    a = read_labels(spark, f"{base}/a", "quality").withColumn("capture", F.lit("A"))
    b = read_labels(spark, f"{base}/b", "toxic").withColumn("capture", F.lit("B"))
    out = add_positions(a.unionByName(b), "capture")
    return out.select(F.col("capture").alias("layout"), "pos", "label")


# Captures of the build stand-in: event type -> (leading index?, label layout); a type
# that the table holds besides gets OTHER
BUILD_CAPTURES = {
    "click": (True, "A"),
    "error": (False, "A"),
    "purchase": (False, "B"),
    "signup": (False, "B"),
    "view": (False, "A"),
}
OTHER = (False, "A")


def _stage_build(spark, sf_dir) -> list[tuple]:
    """One partitioned write per file layout (not one write per capture)."""
    base = scratch_path(spark, "build_dataset")
    ev = decode_props(read_table(spark, sf_dir, "events"), "props", "k").withColumn(
        "label", (F.col("value") > 100).cast("int"))
    kind = F.col("event_type")
    # one capture for each type of the table: a handful of values
    types = [r[0] for r in ev.select("event_type").distinct().collect() if r[0] is not None]
    captures = {t: BUILD_CAPTURES.get(t, OTHER) for t in sorted(types)}

    def names(pred):
        return [n for n, spec in captures.items() if pred(spec)]

    indexed, plain = names(lambda s: s[0]), names(lambda s: not s[0])
    lay_a, lay_b = names(lambda s: s[1] == "A"), names(lambda s: s[1] == "B")
    write_ordered_csv(ev.filter(kind.isin(indexed)), "event_id",
                      ["event_id", "value", "k"], f"{base}/x_indexed", by="event_type")
    write_ordered_csv(ev.filter(kind.isin(plain)), "event_id", ["value", "k"],
                      f"{base}/x_plain", by="event_type")
    write_layout_a(ev.filter(kind.isin(lay_a)), "event_id", "label", f"{base}/y_a",
                   by="event_type")
    write_layout_b(ev.filter(kind.isin(lay_b)), "event_id", "label", f"{base}/y_b",
                   by="event_type")
    sources = []
    for name, (has_index, layout) in captures.items():
        x = f"{base}/x_indexed" if has_index else f"{base}/x_plain"
        y = f"{base}/y_a" if layout == "A" else f"{base}/y_b"
        sources.append((name, f"{x}/event_type={name}", f"{y}/event_type={name}"))
    return sources, base


def built_table(spark, sf_dir) -> DataFrame:
    sources, base = _stage_build(spark, sf_dir)
    write_parquet(build_labelled_table(spark, sources, n_features=2, keep_pos=True), f"{base}/global")
    return spark.read.parquet(f"{base}/global")


def q_union_tagged_sources(spark, sf_dir):
    """U1 + P4 on its own: the per-type capture files unioned with their tags."""
    from vigil.operators.align import union_tagged
    sources, _ = _stage_build(spark, sf_dir)
    parts = [(name, read_features(spark, fx, 2, name)) for name, fx, _ in sources]
    return union_tagged(parts).select("f0", "f1", "attack_name")


def q_build_dataset(spark, sf_dir):
    return built_table(spark, sf_dir).select("f0", "f1", "label", "attack_name")


def q_source_counts(spark, sf_dir):
    """Rows by source, observed by the write of the build itself."""
    sources, base = _stage_build(spark, sf_dir)
    counts = write_counted(build_labelled_table(spark, sources, n_features=2, keep_pos=True),
                           f"{base}/global", [s[0] for s in sources])
    return spark.createDataFrame(list(counts.items()), "attack_name string, n long")


STAGED_QUERIES = {
    "positional_label_join": q_positional_label_join,
    "label_parse_guard": q_label_parse_guard,
    "union_tagged_sources": q_union_tagged_sources,
    "build_dataset": q_build_dataset,
    "source_counts": q_source_counts,
}
