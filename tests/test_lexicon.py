import pytest

from dualscript.operators import lexicon as L
from dualscript.operators import lookup
from dualscript.plans import queries

LINES = [
    "p :: (1번지)/(일번지)가 좋다", "p :: 오늘 (1시)/(한 시)에 보자", "p :: 오늘 (1시)/(한 시)에 가자",
    "p :: 내일 (1시)/(일 시)에 가자", "p :: (5%)/(오%) 빠짐", "p :: u/(12)/(십이), (3)/(삼)",
]


@pytest.fixture(scope="module")
def lines(frame):
    return frame([(i, s) for i, s in enumerate(LINES)], "pos int, raw string")


def test_readings(lines):
    got = sorted(tuple(r) for r in L.readings(lines).collect())
    assert got == sorted([
        ("1번지가", "일번지가", "좋다"), ("1시에", "한 시에", "보자"), ("1시에", "한 시에", "가자"),
        ("1시에", "일 시에", "가자"), ("12", "십이", ""), ("3", "삼", ""),
    ])


def test_lexicon_and_ties(lines):
    got = {(r.src, r.next_token): (r.dst, r.n) for r in L.reading_lexicon(lines).collect()}
    assert got[("1시에", None)] == ("한 시에", 2)
    assert got[("1시에", "가자")] == ("일 시에", 1)  # a tie goes to the smaller reading
    assert got[("12", None)] == ("십이", 1)


def test_convert_both_ways(frame, lines):
    df = frame([(0, "오늘 1시에 가자"), (1, "1시에 보자 12"), (2, "없음"), (3, ""), (4, "1시에 와")], "id int, t string")
    out = L.convert(df, "id", "t", L.reading_lexicon(lines))
    assert {r.id: r.converted for r in out.collect()} == {
        0: "오늘 일 시에 가자", 1: "한 시에 보자 십이", 2: "없음", 3: "", 4: "한 시에 와",
    }
    back = frame([(0, "오늘 한 시에 가자 십이 삼")], "id int, t string")
    out = L.convert(back, "id", "t", L.reading_lexicon(lines, "TTN"))
    assert out.first().converted == "오늘 1시에 가자 12 3"


def test_leftmost_longest(frame):
    rows = [("a b", None, "AB", 1), ("b c d", None, "BCD", 1), ("d", None, "D", 1), ("d", "e", "DE", 1)]
    lex = frame(rows, "src string, next_token string, dst string, n bigint")
    df = frame([(0, "a b c d e"), (1, "x b c d"), (2, "a b a b d")], "id int, t string")
    got = {r.id: r.converted for r in L.convert(df, "id", "t", lex).collect()}
    assert got == {0: "AB c DE e", 1: "x BCD", 2: "AB AB D"}


def test_texts_are_probed_once_above_the_broadcast_threshold(frame, spark, lines, monkeypatch):
    """The sketch of the phrases reads stored places, not the texts and the first lookup again."""
    df = frame([(0, "오늘 1시에 가자"), (1, "1시에 보자 12"), (2, "없음"), (3, ""), (4, "1시에 와"), (5, "3 12 3")], "id int, t string")
    lex = L.reading_lexicon(lines)
    small = {r.id: r.converted for r in L.convert(df, "id", "t", lex).collect()}
    plans, sketch = [], lookup.frequent_keys

    def planned(left, on):
        plans.append(left._jdf.queryExecution().optimizedPlan().toString())
        return sketch(left, on)

    monkeypatch.setattr(lookup, "frequent_keys", planned)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "1")
    try:
        large = {r.id: r.converted for r in L.convert(df, "id", "t", lex).collect()}
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert large == small and small[5] == "삼 십이 삼"
    tokens, phrases = plans
    assert "Generate" in tokens and "Repartition" not in tokens
    assert all(x not in phrases for x in ("Join", "Aggregate", "Generate", "Repartition"))


def test_scoring_judges_each_line_once(spark, monkeypatch):
    calls, judge = [], queries.pairs.valid_pairs
    monkeypatch.setattr(queries.pairs, "valid_pairs", lambda *a: calls.append(a) or judge(*a))
    out = queries.QUERIES["lexicon_eval"](spark, "/root/testdata/sf0.001").collect()
    assert len(calls) == 1 and len(out) == 1 and 0 < out[0]["rouge1"] < 1


def test_a_very_wide_phrase(frame, spark):
    """Only places where it may begin look further than one token."""
    wide = " ".join(f"w{k}" for k in range(300))
    lex = frame([(wide, None, "WIDE", 1), ("w0", None, "W0", 2), ("w7 w8", None, "PAIR", 1)],
                "src string, next_token string, dst string, n bigint")
    df = frame([(0, f"x {wide} y"), (1, "w0 w1 w7 w8 w0"), (2, " ".join(["z"] * 2000)), (3, wide[:-1]), (4, "")], "id int, t string")
    got = {r.id: r.converted for r in L.convert(df, "id", "t", lex).collect()}
    assert got[0] == "x WIDE y" and got[1] == "W0 w1 PAIR W0" and got[2] == " ".join(["z"] * 2000) and got[4] == ""
    assert got[3].startswith("W0 w1 w2") and "PAIR" in got[3]
    from dualscript.functions import text as T
    from pyspark.sql import functions as F
    from dualscript.sources.storage import materialise

    back_off = lex.select(F.col("src").alias("phrase"), "n")
    starts = materialise(L._starts(back_off), "starts")
    assert L._candidates(df.select("id", T.tokens(F.col("t")).alias("words")), "id", starts).count() == (2 + 1) + (1 + 1 + 1) + (2 + 1)
