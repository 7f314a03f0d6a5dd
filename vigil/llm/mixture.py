"""Mixing sources to target weights: quotas of blocks go down a splitting tree.

1. Documents of a source lie end to end, in the order of a hash of their ids, on a
   line of words; walked twice, it is cut into blocks.  A source's quota is the
   number of blocks that its target takes from the start of that line, the last
   one cut at the word, so quotas are exact.
2. The tree splits the shards in halves down to single ones.  A node's left half
   takes its share of the node's blocks; how many come from each source is a
   multivariate hypergeometric draw, source after source, each from the blocks
   that are left.  So every shard has as many blocks as its share, and its sources
   are as mixed as if all blocks had been shuffled.
3. A shard's blocks are the next ones of each source's permuted line, so shards are
   disjoint; within a shard the pieces are ordered by another hash.

Targets: sources in code point order (null last) weigh ``weights`` in turn and share
``share`` times all words; a target stops at ``repeats`` times its source, and what
is over is shared again by weight until no target is above.

DataFrame functions only.  Running sums come from range partitions with one small
table of their totals, so neither a hot source nor a hot id meets in one task: equal
rows fold to one with a count and are dealt out again in bounded runs.  The quotas
of a tree node are one row, eight bytes a source.

Defined cases: a null or empty text has size 0 and is never taken; a null source is a
source of its own, the last one; rows that repeat are documents of their own; a null
doc_id sorts first; other columns are not looked at; no rows give no rows; if all
sizes are 0, so are all targets.  The result depends on ids, sources and texts alone,
not on how the table is cut.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vigil.llm.frames import freeze, parallelism, same, small_batches

WEIGHTS, SHARE, REPEATS = (3, 1, 2), 1.5, 2
WORDS_A_SHARD, LEAST_SHARDS, BLOCKS_A_SHARD = 50_000_000, 16, 1024
SEED = 13
COPIES_A_RUN = 4096
BROADCAST_BYTES = 8 << 20
# fixed value: a word is a run of anything but ASCII white space
WORD = r"[^\x20\x09-\x0D]+"


# ------------------------------------------------------------------ running sums
def running(df: DataFrame, order: list[Column], sums: dict[str, Column]) -> DataFrame:
    """``df`` with, for each of ``sums``, its total over all rows before in ``order``.

    The order is cut into ranges; a table of one row a range carries totals from
    range to range, and windows run inside ranges alone.
    """
    cut = freeze(df.repartitionByRange(parallelism(df), *order)
                 .withColumn("_range", F.spark_partition_id()), "ranges")
    totals = cut.groupBy("_range").agg(*[F.sum(c).alias(f"_t_{k}") for k, c in sums.items()])
    earlier = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    start = totals.select("_range", *[F.coalesce(F.sum(f"_t_{k}").over(earlier), F.lit(0)).alias(f"_s_{k}")
                                      for k in sums])
    inside = Window.partitionBy("_range").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    # one row a partition: bounded by the number of partitions
    out = cut.select("*", *[F.coalesce(F.sum(c).over(inside), F.lit(0)).alias(f"_w_{k}")
                            for k, c in sums.items()]).join(F.broadcast(start), "_range")
    return out.select(*df.columns, *[(F.col(f"_s_{k}") + F.col(f"_w_{k}")).alias(k) for k in sums])


# ----------------------------------------------------------------------- targets
def _distinct(docs: DataFrame) -> DataFrame:
    """(source, key, doc_id, size, fp, n): documents with their words counted, equal ones folded."""
    small_batches(docs.sparkSession)
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.select(F.col("source").cast("string").alias("source"), F.col("doc_id").cast("long").alias("doc_id"),
                       F.regexp_count(text, F.lit(WORD)).cast("long").alias("size"),
                       F.xxhash64(text).alias("fp"))
    key = F.substring(F.md5(F.concat(F.lit(f"{SEED}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
                            .cast("binary")), 1, 16)
    return rows.groupBy("source", "doc_id", "size", "fp").agg(F.count("*").alias("n")).withColumn("key", key)


def source_targets(folded: DataFrame, weights: tuple = WEIGHTS, share: float = SHARE,
                   repeats: int = REPEATS) -> DataFrame:
    """(source, rank, start, source_size, target, take): one row a source."""
    sizes = folded.groupBy("source").agg(F.sum(F.col("size") * F.col("n")).alias("source_size"))
    ranked = running(sizes, [F.asc_nulls_last("source")], {"rank": F.lit(1), "start": F.col("source_size")})
    turn = F.array(*[F.lit(float(w)) for w in weights])
    caps = ranked.withColumn("w", F.get(turn, F.col("rank") % len(weights))) \
        .withColumn("cap", F.col("source_size") * repeats) \
        .withColumn("ratio", F.col("cap") / F.col("w"))
    filled = running(caps, [F.asc("ratio"), F.asc("rank")], {"capped": F.col("cap"), "held": F.col("w")})
    both = filled.agg(F.sum("source_size").alias("words"), F.sum("w").alias("weight")).first()
    if both["words"] is None:
        return filled.select("source", "rank", "start", "source_size", F.lit(0.0).alias("target"),
                             F.lit(0).cast("long").alias("take"))
    # the level of all sources from this one on, if those before it stop at their caps
    level = (F.lit(share * both["words"]) - F.col("capped")) / (F.lit(both["weight"]) - F.col("held"))
    settled = filled.withColumn("level", level).where(F.col("w") * F.col("level") <= F.col("cap")) \
        .agg(F.min(F.struct("ratio", "rank", "level"))["level"].alias("level")).first()["level"]
    target = F.least(F.col("cap").cast("double"), F.col("w") * F.lit(float(settled)))
    return filled.select("source", "rank", "start", "source_size", target.alias("target"),
                         F.least("cap", F.round(target).cast("long")).alias("take"))


# ---------------------------------------------------------------- splitting tree
def _let(name: str, value: str, body: str) -> str:
    """SQL for ``body`` with ``name`` standing for a value that is computed once."""
    return f"transform(array({value}), {name} -> {body})[0]"


def _log_factorial(n: str) -> str:
    stirling = (f"f * ln(f) - f + 0.5D * ln({2 * math.pi!r}D * f) + 1 / (12 * f) - 1 / (360 * f * f * f)"
                " + 1 / (1260 * f * f * f * f * f)")
    return f"if({n} <= 20, ln(factorial(cast({n} AS int))), {_let('f', f'cast({n} AS double)', stirling)})"


def hypergeometric(population: str, marked: str, drawn: str, u: str) -> str:
    """SQL: how many of ``drawn`` items out of ``population`` are ``marked``, by inverting u in [0, 1).

    Sums the probabilities over ten standard deviations about the mean, or over the
    whole range where that is shorter; each follows from the last one, so logarithms
    are taken for the first alone.
    """
    log_p = " ".join(sign + _log_factorial(n) for sign, n in (
        ("+", "r.k"), ("-", "r.low"), ("-", "(r.k - r.low)"), ("+", "(r.p - r.k)"), ("-", "(r.n - r.low)"),
        ("-", "(r.p - r.k - r.n + r.low)"), ("-", "r.p"), ("+", "r.n"), ("+", "(r.p - r.n)")))
    step = """named_struct('total', s.total + s.p,
        'p', s.p * (r.k - x) * (r.n - x) / ((x + 1) * (r.p - r.k - r.n + x + 1D)),
        'x', s.x + if(s.total + s.p <= r.u, 1L, 0L))"""
    invert = f"""least(r.high, aggregate(sequence(r.low, r.high),
        named_struct('total', 0D, 'p', exp({log_p}), 'x', r.low), (s, x) -> {step}).x)"""
    limits = """named_struct('p', v.p, 'k', v.k, 'n', v.n, 'u', v.u,
        'low', greatest(v.n + v.k - v.p, floor(m.mean - m.wide), 0L),
        'high', least(v.n, v.k, ceil(m.mean + m.wide)))"""
    # an empty population yields nothing
    spread = """v.n * v.k / greatest(v.p, 1L) * (1 - v.k / greatest(v.p, 1L))
        * (v.p - v.n) / greatest(v.p - 1, 1L)"""
    moments = f"""named_struct('mean', v.n * (v.k / greatest(v.p, 1L)),
        'wide', 10 * sqrt(greatest({spread}, 0D)) + 10)"""
    return _let("v", f"named_struct('p', {population}, 'k', {marked}, 'n', {drawn}, 'u', {u})",
                _let("m", moments, _let("r", limits, invert)))


# a multivariate draw: source after source, each from the blocks that are left
_TOTAL = "aggregate({}, 0L, (a, x) -> a + x)"
_UNIFORM = f"shiftrightunsigned(xxhash64({SEED}, node, i), 11) / {float(1 << 53)!r}D"
_DRAW = f"""aggregate(slice(sequence(0, size(quotas)), 1, size(quotas)),
    named_struct('left', cast(array() AS array<bigint>), 'population', {_TOTAL.format("quotas")}),
    (acc, i) -> named_struct(
        'left', concat(acc.left, array({hypergeometric(
            "acc.population", "quotas[i]", "n_left - " + _TOTAL.format("acc.left"), _UNIFORM)})),
        'population', acc.population - quotas[i])).left"""


def shard_quotas(quotas: DataFrame, n_shards: int) -> DataFrame:
    """(shard, quotas): the blocks of each source (in order) that go to each shard.

    ``quotas`` is one row with the array ``quotas`` of long.
    """
    tree = quotas.selectExpr("0L AS first", f"{n_shards}L AS n", "quotas")
    sides = ("first", "n", "quotas", "n div 2 AS half", f"{_TOTAL.format('quotas')} * (n div 2) div n AS n_left",
             "xxhash64(first, n) AS node")
    children = """explode(if(half = 0, array(named_struct('first', first, 'n', n, 'quotas', quotas)), array(
        named_struct('first', first, 'n', half, 'quotas', left),
        named_struct('first', first + half, 'n', n - half, 'quotas', zip_with(quotas, left, (a, b) -> a - b))))) AS c"""
    for level in range((n_shards - 1).bit_length()):
        if level == 5:     # 32 nodes: from here on they are split side by side
            tree = tree.repartition(parallelism(quotas), "first")
        tree = tree.selectExpr(*sides).selectExpr("*", f"{_DRAW} AS left").selectExpr(children).select("c.*")
    return tree.select(F.col("first").alias("shard"), "quotas")


def _cuts(sources: DataFrame, n_shards: int, width: int) -> DataFrame:
    """``sources`` with ``ends``: the word of its line at which each shard's blocks end."""
    blocks = sources.select("rank", F.ceil(F.col("take") / width).alias("q"))
    root = blocks.agg(F.transform(F.sort_array(F.collect_list(F.struct("rank", "q"))),
                                  lambda s: s["q"]).alias("quotas"))
    leaves = shard_quotas(root, n_shards).select("shard", F.posexplode("quotas").alias("_rank", "q"))
    upto = Window.partitionBy("_rank").orderBy("shard")
    ends = leaves.select("_rank", "shard", (F.sum("q").over(upto) * width).alias("end")).groupBy("_rank").agg(
        F.transform(F.sort_array(F.collect_list(F.struct("shard", "end"))), lambda s: s["end"]).alias("ends"))
    return sources.join(ends, F.col("rank") == F.col("_rank")).withColumn(
        "ends", F.transform("ends", lambda e: F.least(e, "take"))).drop("_rank")


# ------------------------------------------------------------------------ pieces
def _shard_at(word: str, steps: int) -> str:
    """SQL, a binary search: the first shard whose end lies beyond a word of the line."""
    return f"""aggregate(sequence(1, {steps}), named_struct('lo', 0, 'hi', size(ends) - 1, 'w', {word}),
        (s, i) -> named_struct('lo', if(ends[(s.lo + s.hi) div 2] > s.w, s.lo, cast((s.lo + s.hi) div 2 AS int) + 1),
                               'hi', if(ends[(s.lo + s.hi) div 2] > s.w, cast((s.lo + s.hi) div 2 AS int), s.hi),
                               'w', s.w)).lo"""


def _pieces(number: int, steps: int) -> str:
    """SQL: the pieces of a document in one pass over its source."""
    piece = f"""named_struct('shard', s, 'place', xxhash64({SEED}, s, source, doc_id, fp, copy, {number}),
        'pass', {number}, 'start', greatest(0L, if(s > 0, ends[s - 1], 0L) - a), 'end', least(b, ends[s]) - a)"""
    found = f"""filter(transform(sequence({_shard_at('a', steps)}, {_shard_at('b - 1', steps)}), s -> {piece}),
        p -> p.end > p.start)"""
    none = "cast(array() AS array<struct<shard:int,place:bigint,pass:int,start:bigint,end:bigint>>)"
    begin = f"at + source_size * {number}"
    return _let("a", begin, _let("b", "least(a + size, take)", f"if(b > a, {found}, {none})"))


def _copies(line: DataFrame) -> DataFrame:
    """One row a document again; many equal ones are dealt out in bounded runs."""
    lone, many = line.where("n = 1").withColumn("copy", F.lit(0).cast("long")), line.where("n > 1")
    runs = many.withColumn("run", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("n") - 1) / COPIES_A_RUN)))) \
        .repartition(parallelism(line), "source", "doc_id", "size", "fp", "run")
    first = F.col("run") * COPIES_A_RUN
    last = F.least(first + COPIES_A_RUN, F.col("n")) - 1
    return lone.unionByName(runs.withColumn("copy", F.explode(F.sequence(first, last))).drop("run"))


def mixture(docs: DataFrame, weights: tuple = WEIGHTS, share: float = SHARE, repeats: int = REPEATS,
            words_a_shard: int = WORDS_A_SHARD) -> DataFrame:
    """Every document with its pieces of the mix.

    (doc_id, source, fp, copy, size, source_size, target, pieces): ``pieces`` are
    (shard, place, pass, start, end), words start to end of the document in a pass over
    its source; the mix is the pieces by (shard, place).  ``fp`` is xxhash64 of the text.
    """
    folded = freeze(_distinct(docs), "sized")
    sources = freeze(source_targets(folded, weights, share, repeats), "targets")
    stats = sources.agg(F.count("*").alias("n"), F.sum("take").alias("take")).first()
    take = stats["take"] or 0
    n_shards = max(LEAST_SHARDS, math.ceil(take / words_a_shard))
    width = max(1, math.ceil(take / (n_shards * BLOCKS_A_SHARD)))
    cuts = freeze(_cuts(sources, n_shards, width), "cuts").withColumnRenamed("source", "_source")
    if stats["n"] * (n_shards * 8 + 200) <= BROADCAST_BYTES:
        cuts = F.broadcast(cuts)    # beyond, a shuffle join, whose hot sources adaptive execution splits
    order = [F.asc_nulls_last("source"), F.asc("key"), F.asc_nulls_first("doc_id"), F.asc("size"), F.asc("fp")]
    line = running(folded, order, {"before": F.col("size") * F.col("n")})
    placed = line.join(cuts, same(F.col("source"), F.col("_source")))
    rows = _copies(placed).withColumn("at", F.col("before") - F.col("start") + F.col("copy") * F.col("size"))
    steps = n_shards.bit_length() + 1
    passes = ", ".join(_pieces(k, steps) for k in range(repeats))
    return rows.selectExpr("doc_id", "source", "fp", "copy", "size", "source_size", "target",
                           f"concat({passes}) AS pieces")


def mix_digest(docs: DataFrame) -> DataFrame:
    """(doc_id, size, source_size, target, taken) of every document."""
    return mixture(docs).selectExpr("doc_id", "size", "source_size", "target",
                                    "aggregate(pieces, 0L, (a, p) -> a + p.end - p.start) AS taken")


def mixed_texts(docs: DataFrame, **how) -> DataFrame:
    """(shard, place, doc_id, source, text): the mix itself, to be written by shard, sorted by place."""
    pieces = mixture(docs, **how).select(
        F.col("doc_id").alias("_d"), F.col("source").alias("_s"), F.col("fp").alias("_f"), "size",
        F.explode("pieces").alias("p"))
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("source"),
                        text.alias("text"), F.xxhash64(text).alias("fp")).dropDuplicates(["doc_id", "source", "fp"])
    met = pieces.join(texts, same(F.col("_d"), F.col("doc_id")) & same(F.col("_s"), F.col("source"))
                      & (F.col("_f") == F.col("fp")))
    words = F.slice(F.regexp_extract_all("text", F.lit(WORD), F.lit(0)), (F.col("p.start") + 1).cast("int"),
                    (F.col("p.end") - F.col("p.start")).cast("int"))
    whole = F.col("p.end") - F.col("p.start") == F.col("size")
    return met.select("p.shard", "p.place", "doc_id", "source",
                      F.when(whole, F.col("text")).otherwise(F.array_join(words, " ")).alias("text")) \
        .repartition(parallelism(docs), "shard").sortWithinPartitions("shard", "place")
