import random

import numpy as np
import pyarrow as pa
import pytest

from tests.conftest import SF01
from tests.llm import cases
from vigil.llm import decontaminate, pieces, quality, tokens


# ------------------------------------------------------------------- quality
def test_quality_holds_out_and_is_accurate(spark):
    docs, labels = (spark.read.parquet(f"{SF01}/{t}.parquet") for t in ("documents", "labels"))
    got = quality.scores(docs, labels).join(labels, "doc_id").toPandas()
    import zlib
    assert (got.held_out == [zlib.crc32(str(i).encode()) % 3 == 1 for i in got.doc_id]).all()
    assert ((got.predicted == got.quality) | ~got.held_out).sum() >= 0.95 * len(got)
    assert got[got.held_out].eval("predicted == quality").mean() > 0.95
    assert got.score.between(0, 1).all()


def test_quality_without_labels_keeps_all(spark):
    docs = cases.frame(spark, cases.odd_texts())
    labels = spark.createDataFrame([(None, 1, 0), (1, None, 0), (3, 7, 0)], "doc_id long, quality int, toxic int")
    out = quality.good_documents(docs, labels)
    assert out.columns == docs.columns and out.count() == docs.count()
    assert {r.score for r in quality.scores(docs, labels).collect()} == {1.0}


def test_quality_odd_texts_and_labels(spark):
    docs = cases.frame(spark, cases.odd_texts())
    labels = spark.createDataFrame([(i, int(i % 4 != 0), 0) for i in range(1, 24)],
                                   "doc_id long, quality int, toxic int")
    got = quality.scores(docs, labels).collect()
    assert len(got) == docs.count() and all(0 <= r.score <= 1 for r in got)
    assert quality.scores(docs.limit(0), labels).count() == 0


def test_rules_compile_to_the_same_scores(spark):
    model = quality.RuleModel(0.5, [(1.5, (("upper_share", True, 0.2), ("log_words", False, 3.0))),
                                    (-2.0, (("digit_share", True, 0.1),))])
    texts = ["ABC def", "aa 12 34", "", "x " * 50]
    x = quality.text_stats(pa.array(texts))
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    got = [r[1] for r in sorted(quality.with_stats(docs).select("row.doc_id", model.score()).collect())]
    at = {n: i for i, n in enumerate(quality.STATS)}
    for row, score in zip(x, got):
        z = 0.5 + 1.5 * (row[at["upper_share"]] > 0.2 and row[at["log_words"]] <= 3.0) \
            - 2.0 * (row[at["digit_share"]] > 0.1)
        assert score == pytest.approx(1 / (1 + np.exp(-z)))


# ------------------------------------------------------------- decontamination
def plain_tiles(item, doc, least):
    """Greedy string tiling by its definition: again and again the longest free common run."""
    fi, fd, out = [True] * len(item), [True] * len(doc), []
    while True:
        best = (least - 1, 0, 0)
        for i in range(len(item)):
            for d in range(len(doc)):
                n = 0
                while i + n < len(item) and d + n < len(doc) and item[i + n] == doc[d + n] \
                        and fi[i + n] and fd[d + n]:
                    n += 1
                if n > best[0]:
                    best = (n, i, d)
        n, i, d = best
        if n < least:
            return out
        out.append((i, d, n))
        fi[i:i + n] = [False] * n
        fd[d:d + n] = [False] * n


@pytest.mark.parametrize("seed", range(25))
def test_tiling_covers_like_plain_version(seed):
    rnd = random.Random(seed)
    item = [rnd.randrange(9) for _ in range(rnd.randrange(6, 50))]
    doc = [rnd.randrange(9) for _ in range(40)]
    for _ in range(rnd.randrange(5)):
        a, at = rnd.randrange(len(item)), rnd.randrange(40)
        doc[at:at] = item[a:a + rnd.randrange(4, 30)]
    i, d = (tokens.mix(np.array(x, np.uint64) + np.uint64(1)) for x in (item, doc))
    got = decontaminate.greedy_tiles(i, d, np.arange(len(d)), 3)
    want = plain_tiles(item, doc, 3)
    assert sorted(t[2] for t in got) == sorted(t[2] for t in want)
    used = [p for _, d0, n in got for p in range(d0, d0 + n)]
    assert len(used) == len(set(used))
    assert all(item[a:a + n] == doc[b:b + n] for a, b, n in got)


@pytest.fixture(scope="module")
def benchmark(spark):
    rnd = random.Random(4)
    items = [(k, " ".join(f"q{k}x{rnd.randrange(99)}" for _ in range(40))) for k in range(12)]
    return items, spark.createDataFrame([*items, (90, None), (91, ""), (92, "too short item")],
                                        "item_id long, text string")


def test_leaks_are_found_and_clean_documents_left(spark, benchmark):
    items, table = benchmark
    w = items[3][1].split()
    moved = " ".join(w[20:] + ["between"] + w[:20])
    rows = cases.odd_texts() + [(200, "before " + items[0][1].upper() + "! after"), (201, moved),
                                (202, " ".join(w[:12])), (203, items[5][1].replace(" ", ", ")),
                                (204, items[1][1] + " x " + items[2][1])]
    docs = cases.frame(spark, rows).repartition(3)
    got = {r.doc_id: r for r in decontaminate.decontaminate(docs, table).collect()}
    assert sorted(i for i, r in got.items() if r.contaminated) == [200, 201, 203, 204]
    assert got[201].item_id == 3 and got[201].coverage == 1.0 and got[201].n_tiles == 2
    assert got[204].item_id == 1
    many = {r.doc_id: r for r in decontaminate.decontaminate(docs, table, block_bytes=300).collect()}
    assert many == got
    clean = decontaminate.clean_documents(docs, table)
    assert clean.columns == docs.columns and clean.count() == len(rows) - 4


def test_short_and_unspaced_items_match_where_they_stand_whole(spark):
    items = spark.createDataFrame([(1, "Who wrote Emma?"), (2, "\u4e2d\u56fd\u7684\u9996\u90fd\u662f\u54ea\u5ea7\u57ce\u5e02\uff1f"),
                                   (3, "\u0e01\u0e23\u0e38\u0e07\u0e40\u0e17\u0e1e"), (4, "?!"), (5, "Emma")],
                                  "item_id long, text string")
    rows = [(1, "ask: who wrote emma, then"), (2, "who wrote it"), (3, "\u95ee\uff1a\u4e2d\u56fd\u7684\u9996\u90fd\u3001\u662f\u54ea\u5ea7\u57ce\u5e02\u3002\u7b54"),
            (4, "\u4e2d\u56fd\u7684"), (5, "x\u0e01\u0e23\u0e38\u0e07\u0e40\u0e17\u0e1ey"), (6, "emmanuel ?! wrote"), (7, None)]
    got = sorted((r.doc_id, r.item_id, r.coverage) for r in decontaminate.matches(
        cases.frame(spark, rows), items).collect())
    assert got == [(1, 1, 1.0), (1, 5, 1.0), (3, 2, 1.0), (5, 3, 1.0)]


def test_empty_benchmark_and_documents(spark, benchmark):
    docs = cases.frame(spark, cases.odd_texts())
    none = decontaminate.decontaminate(docs, benchmark[1].limit(0))
    assert none.count() == docs.count() and none.where("contaminated").count() == 0
    assert decontaminate.decontaminate(docs.limit(0), benchmark[1]).count() == 0


# ---------------------------------------------------------------------- pieces
@pytest.fixture(scope="module")
def codec():
    return pieces.Codec(pieces.load())


def plain_viterbi(model, text):
    """Best total score over all cuts; of equal ones the longer last piece."""
    known = {p: (s, i) for p, s, i in model["normal"]}
    longest, unknown = max(map(len, known)), min(s for s, _ in known.values()) - pieces.UNKNOWN_PENALTY
    text = " " + text
    best, back = [0.0], [None]
    for i in range(1, len(text) + 1):
        top, via = best[i - 1] + unknown, (1, None)
        for n in range(min(longest, i), 0, -1):
            hit = known.get(text[i - n:i])
            if hit and best[i - n] + hit[0] > top:
                top, via = best[i - n] + hit[0], (n, hit[1])
        best.append(top)
        back.append(via)
    out, i = [], len(text)
    while i:
        n, k = back[i]
        out += [k] if k is not None else [model["bytes"][b] for b in reversed(text[i - 1].encode())]
        i -= n
    return out[::-1]


TEXTS = ["hello world", " ", "   two  spaces ", "▁ literal ▁▁ mark", "\n\ttab\x00nul", "漢字 かな 😀 é",
         "a" * 300, "x" + " " * 70 + "y", "don't stop-believing, 3.14!"]


def test_encoding_like_plain_viterbi(codec):
    model = pieces.load()
    rnd = random.Random(0)
    texts = TEXTS + ["".join(rnd.choices("abehint ,.é▁ ", k=60)) for _ in range(60)]
    for t in texts:
        assert codec.encode(t) == plain_viterbi(model, t)
        assert codec.decode(codec.encode(t)) == t


def test_round_trip_on_documents(spark):
    rows = cases.odd_texts() + [(300 + k, t) for k, t in enumerate(TEXTS)]
    docs = cases.frame(spark, rows).repartition(3)
    enc = pieces.encode(docs)
    assert enc.where("NOT round_trip OR n_tokens <> size(ids)").count() == 0
    back = sorted(((r.doc_id, r.text) for r in pieces.decode(enc).collect()), key=repr)
    assert back == sorted(((i, t or "") for i, t in rows), key=repr)
    assert pieces.encode(docs.limit(0)).count() == 0
    assert pieces.decode(spark.createDataFrame([(1, None)], "doc_id long, ids array<int>")).first().text == ""
