"""Quality classifier: a sparse ensemble of rules over text statistics.

1. Every whole text becomes a row of statistics (vectorised, one pass).
2. Shallow trees are grown on a bounded sample of labelled rows; every path
   from a root to a node is a conjunctive rule over the statistics.
3. Lasso logistic regression weighs the rules; most weights become zero.
4. The rules that are left compile to one Spark column expression, which scores
   all rows without Python or model objects.

Only rows whose crc32(doc_id as text) mod 3 is not 1 teach; the labels, lang,
source and doc_id never enter a score.  The sample is the first ``max_labels``
labelled rows in the order of a hash of the id.

Defined cases: null and empty texts have zero statistics and are scored like
any other; labels that are null or neither 0 nor 1 are ignored; repeated rows
are scored each by itself; without labels of both kinds every score is the
share of label 1 (1.0 without any label).
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vigil.llm import tokens
from vigil.llm.frames import freeze, small_batches

MAX_LABELS = 20_000
TREES, DEPTH, LASSO = 24, 3, 0.002
STATS = ["log_chars", "log_words", "word_length", "upper_share", "digit_share", "symbol_share",
         "stop_share", "bare_symbol_words", "symbol_ended_words", "distinct_words",
         "top_word_share", "repeated_word_share", "words_per_line", "non_ascii_share"]

_ALNUM, _UPPER, _LETTER, _DIGIT, _SYMBOL, _STOP = (
    np.array([i < 128 and f(chr(i)) for i in range(256)]) for f in (
        str.isalnum, str.isupper, str.isalpha, str.isdigit,
        lambda c: c.isprintable() and not c.isalnum() and c not in " .,'-\"", lambda c: c in ".,"))


def text_stats(col: pa.Array) -> np.ndarray:
    """One row of STATS for each text."""
    w = tokens.Words(col)
    data, off = tokens.text_buffer(col)
    n = len(off) - 1

    def count(mask, edges=off):
        total = np.concatenate([[0], np.cumsum(mask, dtype=np.int64)])
        return (total[edges[1:]] - total[edges[:-1]]).astype(float)

    def of_words(mask):
        return np.bincount(w.row[mask], minlength=n).astype(float)

    n_bytes, n_words = np.diff(off).astype(float), np.diff(w.first).astype(float)
    n_chars = count((data & 0xC0) != 0x80)
    per_byte, per_word = np.maximum(n_bytes, 1), np.maximum(n_words, 1)
    named = _ALNUM[data] | (data >= 128)
    named_before = np.concatenate([[0], np.cumsum(named, dtype=np.int64)])
    bare = named_before[w.end] == named_before[w.start]
    ended = _SYMBOL[data[w.end - 1]] if len(w) else np.zeros(0, bool)
    again = np.zeros(len(w), bool)
    again[1:] = (w.hash[1:] == w.hash[:-1]) & (w.row[1:] == w.row[:-1])
    order = np.lexsort((w.hash, w.row))
    h, r = w.hash[order], w.row[order]
    new = np.ones(len(h), bool)
    new[1:] = (h[1:] != h[:-1]) | (r[1:] != r[:-1])
    at = np.flatnonzero(new)
    top = np.zeros(n)
    np.maximum.at(top, r[at], np.diff(np.append(at, len(h))).astype(float))
    return np.column_stack([
        np.log1p(n_chars), np.log1p(n_words), count(~tokens.WHITE[data]) / per_word,
        count(_UPPER[data]) / np.maximum(count(_LETTER[data]), 1), count(_DIGIT[data]) / per_byte,
        count(_SYMBOL[data]) / per_byte, count(_STOP[data]) / per_byte, of_words(bare) / per_word,
        of_words(ended) / per_word, np.bincount(r[at], minlength=n) / per_word, top / per_word,
        of_words(again) / per_word, n_words / (count(data == 10) + 1),
        count(data >= 0xC0) / per_byte])


def with_stats(docs: DataFrame, text: str = "text") -> DataFrame:
    """(row, stats): each row of ``docs`` as a struct, and its statistics."""
    small_batches(docs.sparkSession)
    src = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("row"),
                      docs[text].cast("string").alias("text"))
    schema = T.StructType([src.schema["row"], *[T.StructField(s, T.DoubleType()) for s in STATS]])

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in tokens.chunks(batches):
            x = text_stats(b.column(1))
            yield pa.RecordBatch.from_arrays(
                [b.column(0), *[pa.array(c) for c in x.T]], ["row", *STATS])

    return src.mapInArrow(measure, schema)


def held_out(id_col: Column) -> Column:
    return F.coalesce(F.pmod(F.crc32(id_col.cast("string").cast("binary")), F.lit(3)) == 1,
                      F.lit(False))


@dataclass
class RuleModel:
    """Weighted conjunctions: [(weight, ((statistic, is_above, threshold), ...)), ...]."""

    intercept: float
    rules: list

    def score(self) -> Column:
        """The model as one expression over the columns STATS."""
        z = F.lit(self.intercept)
        for weight, path in self.rules:
            z = z + F.when(condition(path), F.lit(weight)).otherwise(F.lit(0.0))
        return F.lit(1.0) / (F.lit(1.0) + F.exp(-z))


def condition(path) -> Column:
    out = F.lit(True)
    for name, above, threshold in path:
        out = out & (F.col(name) > threshold if above else F.col(name) <= threshold)
    return out


def _paths(node, path=()) -> Iterator[tuple]:
    """The conjunctions on the way to each node below the root."""
    if path:
        yield path
    if node.numDescendants() > 0:
        split = node.split()
        name, t = STATS[split.featureIndex()], float(split.threshold())
        yield from _paths(node.leftChild(), (*path, (name, False, t)))
        yield from _paths(node.rightChild(), (*path, (name, True, t)))


def _simplify(path) -> tuple:
    """One bound a side for each statistic, in a fixed order."""
    low, high = {}, {}
    for name, above, t in path:
        side, best = (low, max) if above else (high, min)
        side[name] = best(side[name], t) if name in side else t
    return tuple(sorted([(n, True, t) for n, t in low.items()]
                        + [(n, False, t) for n, t in high.items()]))


def labelled_sample(docs: DataFrame, labels: DataFrame, max_labels: int) -> DataFrame:
    """Statistics and label y of a bounded sample of the rows that may teach."""
    chosen = labels.select(F.col("doc_id").cast("long").alias("_id"),
                           F.col("quality").cast("double").alias("y")) \
        .where(F.col("_id").isNotNull() & F.col("y").isin(0.0, 1.0) & ~held_out(F.col("_id"))) \
        .orderBy(F.xxhash64("_id"), "_id", "y").limit(max_labels)
    src = docs.select(F.col("doc_id").cast("long").alias("_id"), "text")
    # at most max_labels rows of 16 bytes
    rows = src.join(F.broadcast(chosen), "_id").select("text", "y")
    return with_stats(rows).select(*STATS, F.col("row.y").alias("y"))


def fit(docs: DataFrame, labels: DataFrame, max_labels: int = MAX_LABELS, trees: int = TREES,
        depth: int = DEPTH, lasso: float = LASSO) -> RuleModel:
    from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
    from pyspark.ml.feature import VectorAssembler

    sample = freeze(labelled_sample(docs, labels, max_labels), "quality-sample").coalesce(4)
    n, good = sample.agg(F.count("y"), F.sum("y")).first()
    if not n or good in (0.0, float(n)):
        return RuleModel(math.inf if not n or good else -math.inf, [])
    feats = VectorAssembler(inputCols=STATS, outputCol="f").transform(sample).select("f", "y")
    forest = RandomForestClassifier(featuresCol="f", labelCol="y", numTrees=trees, maxDepth=depth,
                                    minInstancesPerNode=3, seed=17).fit(feats)
    paths = sorted({_simplify(p) for t in forest.trees
                    for p in _paths(t._call_java("rootNode"))})
    if not paths:
        return RuleModel(math.log(good / (n - good)), [])
    cols = [f"r{i}" for i in range(len(paths))]
    ruled = sample.select("y", *[condition(p).cast("double").alias(c) for p, c in zip(paths, cols)])
    ruled = VectorAssembler(inputCols=cols, outputCol="f").transform(ruled).select("f", "y").cache()
    lr = LogisticRegression(featuresCol="f", labelCol="y", elasticNetParam=1.0, regParam=lasso,
                            maxIter=60).fit(ruled)
    ruled.unpersist()
    return RuleModel(float(lr.intercept), [(float(c), p) for c, p in zip(lr.coefficients, paths)
                                           if c])


def scores(docs: DataFrame, labels: DataFrame, **options) -> DataFrame:
    """(doc_id, held_out, score, predicted) of every row of ``docs``."""
    model = fit(docs, labels, **options)
    id_ = F.col("row.doc_id").cast("long")
    out = with_stats(docs.select("doc_id", "text")) \
        .select(id_.alias("doc_id"), held_out(id_).alias("held_out"), model.score().alias("score"))
    return out.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def good_documents(docs: DataFrame, labels: DataFrame, **options) -> DataFrame:
    """The rows of ``docs`` with a score of at least 0.5, all columns kept."""
    model = fit(docs, labels, **options)
    return with_stats(docs).where(model.score() >= 0.5).select("row.*")
