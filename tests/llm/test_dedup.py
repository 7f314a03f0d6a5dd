import pytest

from tests.llm import cases
from vigil.llm import line_dedup, near_dedup, substring_dedup


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=repr)


@pytest.fixture(scope="module")
def docs(spark):
    return cases.frame(spark, cases.odd_texts()).repartition(3).cache()


def test_lines_like_plain_version(docs):
    got = rows_of(line_dedup.line_digest(docs).select("doc_id", "n_lines", "n_dropped", "kept_sha256"))
    assert got == sorted(cases.lines_expected(cases.odd_texts()), key=repr)


def test_lines_hot_key_is_split_and_whole(spark):
    rows = [(i, f"the very common line\nown line number {i}\nthe very common line") for i in range(400)]
    df = cases.frame(spark, rows).repartition(6)
    assert line_dedup.hot_keys(line_dedup._rows(df, 10), 8)
    got = rows_of(line_dedup.line_digest(df).select("doc_id", "n_lines", "n_dropped", "kept_sha256"))
    assert got == sorted(cases.lines_expected(rows), key=repr)


def test_lines_are_split_and_hashed_once(spark):
    seen = spark.sparkContext.accumulator(0)

    def counted(batches):
        for b in batches:
            seen.add(b.num_rows)
            yield b

    df = cases.frame(spark, [(i, f"a line of many documents\nand line {i} of one") for i in range(40)])
    bitmaps = line_dedup.keep_bitmaps(df.mapInArrow(counted, df.schema))
    assert bitmaps.count() == 39 and seen.value == 40


def test_emptied_documents_go_and_blank_ones_stay(spark):
    rows = [(1, "the same long line\nanother line here"), (2, "another line here\nthe same long line"),
            (3, "  \n the same long line"), (4, "short\nthe same long line"), (5, ""), (6, None), (7, " \n ")]
    got = line_dedup.dedup_lines(cases.frame(spark, rows), keep_emptied=False).collect()
    assert {r.doc_id: r.text for r in got} == {1: rows[0][1], 4: "short", 5: "", 6: "", 7: " \n "}
    assert line_dedup.dedup_lines(cases.frame(spark, rows)).count() == 7


def test_columns_named_like_the_operators_own(spark):
    df = spark.createDataFrame([(1, "a long enough line", 5, "k", 7, "r"), (2, "a long enough line\nx", 6, "l", 8, "s")],
                               "doc_id long, text string, _n_dropped long, _kept string, _n_lines long, _rest string")
    got = {tuple(r) for r in line_dedup.dedup_lines(df).collect()}
    assert got == {(1, "a long enough line", 5, "k", 7, "r"), (2, "x", 6, "l", 8, "s")}


def test_line_bitmaps_are_runs(spark):
    rows = [(1, "line number one\nline number two\nline number three"),
            (2, "x\nline number one\nline number two\nnew line here\nline number three\ny")]
    bitmap = line_dedup.keep_bitmaps(cases.frame(spark, rows)).collect()
    assert [(r.doc_id, [tuple(x) for x in r.runs], r.n_dropped) for r in bitmap] == [(2, [(1, 2), (4, 1)], 3)]


def test_lines_keep_columns_and_take_effect(docs):
    out = line_dedup.dedup_lines(docs)
    assert out.columns == docs.columns and out.count() == docs.count()
    r = out.where("doc_id = 11").first()
    assert r.text == "x" and r.n_chars == 1 and r.kept == "x"


def test_substrings_like_plain_version(docs):
    got = rows_of(substring_dedup.substring_digest(docs))
    assert got == sorted(cases.repeats_expected(cases.odd_texts()), key=repr)


def test_substrings_hot_passage_over_many_documents(spark):
    passage = " ".join(f"p{i}" for i in range(57))
    rows = [(i, f"{' '.join(f'd{i}x{k}' for k in range(i % 13))} {passage} end{i}") for i in range(150)]
    got = rows_of(substring_dedup.substring_digest(cases.frame(spark, rows).repartition(5)))
    assert got == sorted(cases.repeats_expected(rows), key=repr)


def test_near_duplicates_like_plain_version(docs):
    rows = cases.odd_texts()
    got = near_dedup.near_duplicates(docs).collect()
    expected = cases.classes_expected(rows)
    # rows without doc_id are told apart by text, so only named rows have one answer
    named = sorted((i, c) for (i, t), c in zip(rows, expected) if i is not None)
    assert sorted((r.doc_id, cases.order(r.class_id)) for r in got if r.doc_id is not None) == named
    assert len(got) == len(rows)


def test_near_duplicates_of_a_large_group(spark):
    import random
    rnd = random.Random(2)
    base = [f"b{i}" for i in range(150)]
    rows = []
    for i in range(260):
        w = list(base)
        for _ in range(rnd.randrange(8)):
            w[rnd.randrange(150)] = f"n{rnd.random()}"
        rows.append((i, " ".join(w)))
    got = {r.doc_id: r.class_id for r in near_dedup.near_duplicates(
        cases.frame(spark, rows).repartition(5)).collect()}
    assert [got[i] for i, _ in rows] == cases.classes_expected(rows)


def test_bounded_cells_lose_no_link(spark, monkeypatch):
    monkeypatch.setattr(near_dedup, "CELL_ROWS", 8)
    rows = [(i, " ".join(f"t{k}" for k in range(i, i + 60))) for i in range(40)]
    got = {r.doc_id: r.class_id for r in near_dedup.near_duplicates(cases.frame(spark, rows)).collect()}
    assert [got[i] for i, _ in rows] == cases.classes_expected(rows)


def test_signatures_are_unbiased_for_weights():
    import numpy as np
    import pyarrow as pa
    import random
    rnd = random.Random(1)
    a, b = [], []
    for _ in range(200):
        w = [f"w{rnd.random()}" for _ in range(50)]
        w += w[:25] * rnd.randrange(6)
        v = list(w) + w[:20] * 2
        v[rnd.randrange(50)] = "x"
        a.append(" ".join(w))
        b.append(" ".join(v))
    true = [cases.jaccard(*cases.bags([(0, x), (1, y)])) for x, y in zip(a, b)]
    (_, s), (_, t) = near_dedup.signatures(pa.array(a)), near_dedup.signatures(pa.array(b))
    assert abs(np.mean((s == t).mean(axis=1)) - np.mean(true)) < 0.015


def test_distinct_documents_keep_columns(docs):
    out = near_dedup.distinct_documents(docs)
    assert out.columns == docs.columns
    named = near_dedup.distinct_documents(docs.where("doc_id IS NOT NULL")).collect()
    assert [r.doc_id for r in named if r.doc_id in (1, 2, 3)] == [1, 1]


@pytest.mark.parametrize("run", [line_dedup.line_digest, substring_dedup.substring_digest,
                                 near_dedup.near_duplicates, line_dedup.dedup_lines])
def test_empty_table(spark, run):
    assert run(cases.frame(spark, [])).count() == 0
