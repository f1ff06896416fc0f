import pytest
from pyspark.sql import functions as F

from dualscript.operators import pairs as P
from dualscript.operators import ranking
from dualscript.operators.staging import compute_once

GOLDEN = [
    ("p :: o/ order (12)/(일이) ready", "order 12 ready", "order 일이 ready", "ok"),
    ("p :: (ab)/(5) (5)/(오) x", None, None, "no_numeral"),
    ("p :: 3 out (1)/(일)", None, None, "stray_digit"),
    ("p :: (1) odd", None, None, "odd_brackets"),
    ("p :: b/ none", None, None, "no_bracket"),
    ("p :: (70%)/(칠십%) rate", None, None, "bad_phonetic"),
    ("p :: (70%)/(칠십 퍼센트) rate", "70% rate", "칠십 퍼센트 rate", "ok"),
    ("p :: (3#)/(삼샵) , + sharp   gap", "3샾 sharp gap", "삼샵 sharp gap", "ok"),
    ("p :: (no)/(digit) (either)/(side)", None, None, "no_numeral"),
    ("no delimiter (1)/(일)", None, None, "no_delimiter"),
    ("p :: a (1)/(일) :: tail", "a 1", "a 일", "ok"),
    ("p :: hello/ (1)/(일)", "hell 1", "hell 일", "ok"),
    ("p :: ((1)/(일)", None, None, "bad_phonetic"),
    ("p :: (1)/(일) (ab)/(cd)", "1 ab", "일 ab", "ok"),
    ("p :: ~(2시)/(두 시)! [웃음]; 1", None, None, "stray_digit"),
]


@pytest.fixture(scope="module")
def golden(frame):
    return frame([(i, raw) for i, (raw, *_) in enumerate(GOLDEN)], "pos int, raw string")


def test_golden_pairs(golden):
    got = {r.pos: (r.num_col, r.sen_col) for r in P.valid_pairs(golden).collect()}
    assert got == {i: (n, s) for i, (_, n, s, reason) in enumerate(GOLDEN) if reason == "ok"}


def test_golden_outcomes(golden):
    rows = P.line_outcomes(golden).orderBy("pos").collect()
    assert [r.reason for r in rows] == [g[3] for g in GOLDEN]


def test_no_delimiter_means_whole_line(frame):
    got = P.valid_pairs(frame([(1, "(1)/(일) :: x")], "pos int, raw string"), delimiter=None).first()
    assert (got.num_col, got.sen_col) == ("1 :: x", "일 :: x")


def test_dedup_first_position_last_value(frame):
    df = frame([(1, "a", "x"), (2, "b", "y"), (3, "a", "z")], "pos int, num_col string, sen_col string")
    got = {(r.num_col, r.sen_col, r.pos) for r in P.dedup_pairs(df).collect()}
    assert got == {("a", "z", 1), ("b", "y", 2)}


def test_hot_key_dedup(frame, spark):
    hot = spark.range(3000).select(
        F.col("id").alias("pos"),
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("k"), "id")).alias("num_col"),
        F.concat(F.lit("v"), "id").alias("sen_col"),
    )
    out = P.dedup_pairs(hot)
    assert out.count() == 2001
    assert out.where("num_col = 'hot'").first().asDict() == {"num_col": "hot", "sen_col": "v2997", "pos": 0}


@pytest.mark.parametrize("n", [0, 3, 9, 10, 57])
def test_head_split_sizes(spark, n):
    df = spark.range(n).select(
        (F.col("id") * 7 + 1).alias("pos"), F.col("id").cast("string").alias("num_col"), F.lit("s").alias("sen_col")
    )
    rows = P.head_split(df).orderBy("pos").collect()
    assert [r.split for r in rows] == ["valid"] * int(n * 0.1) + ["train"] * (n - int(n * 0.1))


def test_kth_smallest_over_several_rounds(spark, monkeypatch):
    monkeypatch.setattr(ranking, "SMALL", 400)
    monkeypatch.setattr(ranking, "SAMPLE", 200)
    df = spark.range(20_000).select((F.pmod(F.col("id") * 7919, F.lit(20_000)) * 3).alias("pos"))
    for k in (0, 1, 1999, 10_000, 19_999):
        assert ranking.kth_smallest(df, "pos", k, 20_000) == 3 * k


def test_kth_smallest_of_structs(spark, monkeypatch):
    monkeypatch.setattr(ranking, "SMALL", 400)
    monkeypatch.setattr(ranking, "SAMPLE", 200)
    df = spark.range(900).select(
        F.struct(F.concat(F.lit("f"), F.col("id") % 3).alias("file"), F.col("id").alias("row")).alias("pos")
    )
    assert tuple(ranking.kth_smallest(df, "pos", 450, 900)) == ("f1", 451)
    with pytest.raises(IndexError):
        ranking.kth_smallest(df, "pos", 900, 900)


def test_number_rows(spark):
    df = spark.range(1000).select((F.col("id") * 37 % 1000).alias("v"))
    rows = ranking.number_rows(df, [F.desc("v")], "n", start=5).collect()
    assert sorted((r.n, r.v) for r in rows) == [(5 + i, 999 - i) for i in range(1000)]


def test_hash_split_is_stable_and_close(spark):
    df = spark.range(5000).select(F.col("id").cast("string").alias("num_col"))
    sizes = {r.split: r.n for r in P.split_sizes(P.hash_split(df, seed="1")).collect()}
    assert 350 < sizes["valid"] < 650
    assert P.hash_split(df, seed="1").exceptAll(P.hash_split(df, seed="1")).isEmpty()


def test_filter_on_staged_column_is_not_copied_down(spark):
    df = compute_once(spark.range(3), s=F.sha2(F.col("id").cast("string"), 256)).where("s > 'a'")
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("sha2(") == 1
