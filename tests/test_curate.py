from difflib import SequenceMatcher

import numpy as np
import pytest
from pyspark.sql import functions as F

from dualscript.operators import curate as C
from dualscript.sources import pair_csv

SCHEMA = "num_col string, sen_col string"


def expected_verdict(num, sen, autojunk=True):
    if bool(num) != bool(sen):
        return "quarantine"
    ratio = SequenceMatcher(None, num.encode(), sen.encode(), autojunk).ratio()
    n = len(sen)
    low = ratio <= (0.1 if n <= 10 else 0.2 if n <= 20 else 0.4 if n <= 50 else 0.5)
    if low and num[-1] != sen[-1] and (n > 50 or "가" <= num[-1] <= "힣"):
        return "drop"
    return "keep"


CASES = [
    ("12", "일이", "keep"), ("3가", "나", "drop"), ("가1나", "다라", "keep"),
    ("num_col", "sen_col", "keep"), ("", "", "keep"), ("", "x", "quarantine"), ("x", "", "quarantine"),
    ("가나다라" * 20 + "1나", "나다라" + "가나다라" * 19 + "일다", "drop"),
    ("짧은 1", "아주 " * 30 + "길다", "drop"), ("1 abc", "하나둘셋", "keep"),
    ("오늘 6시", "오늘 여섯 시에 만나자고 했다가 못 만났다", "drop"),
]


def test_golden_verdicts(frame):
    df = frame([(n, s) for n, s, _ in CASES], SCHEMA)
    for junk in (True, False):
        got = {(r.num_col, r.sen_col): r.verdict for r in C.judge_pairs(df, junk).collect()}
        assert got == {(n, s): expected_verdict(n, s, junk) for n, s, _ in CASES}
    assert [expected_verdict(n, s) for n, s, _ in CASES] == [v for *_, v in CASES]
    assert C.filter_pairs(df).count() == sum(v == "keep" for *_, v in CASES)


def test_native_verdicts_agree_with_the_full_rule(frame):
    df = frame([(n, s) for n, s, _ in CASES], SCHEMA)
    for r in C.native_verdicts(df).where("verdict IS NOT NULL").collect():
        assert r.verdict == expected_verdict(r.num_col, r.sen_col)


def test_similarity_is_difflib(frame):
    df = frame([(n, s) for n, s, _ in CASES], SCHEMA)
    for r in C.similarity(df).collect():
        assert r.ratio == SequenceMatcher(None, r.num_col.encode(), r.sen_col.encode()).ratio()


@pytest.mark.parametrize("lengths", [[3, 1, 4, 1, 5, 9, 2, 6], [7], [2, 2, 5, 5], list(range(1, 90))])
def test_profile_matches_numpy(frame, lengths):
    df = frame([("x" * n,) for n in lengths], "t string")
    r = C.length_profile(df, {"t": "t"}).first()
    d = np.array(lengths)
    want = {
        "n": len(d), "mean": d.mean(), "median": np.median(d), "mode": np.bincount(d).argmax(),
        "max": d.max(), "min": d.min(), "std_pop": d.std(), "var_pop": d.var(),
        "iqr": np.subtract(*np.quantile(d, [0.75, 0.25])), "range": d.max() - d.min(),
    }
    assert {k: r[k] for k in want} == pytest.approx(want)
    if len(d) > 1:
        assert (r.std_samp, r.var_samp) == pytest.approx((d.std(ddof=1), d.var(ddof=1)))
    else:
        assert r.std_samp is None and r.var_samp is None


def test_ragged_csv(spark, tmp_path):
    path = tmp_path / "p.csv"
    path.write_text('num_col,sen_col\r\na,b\nonly\nx,y,z\n\n"q ""w"", 1",v\ne,\n', newline="")
    good, bad = pair_csv.read_pairs(spark, str(path))
    assert {tuple(r) for r in good.collect()} == {("a", "b"), ('q "w", 1', "v"), ("e", "")}
    assert {(r.line, r.reason) for r in bad.collect()} == {("only", "too few fields"), ("x,y,z", "too many fields")}
    assert (good.count(), bad.count()) == (3, 2)
    assert pair_csv.read_pairs(spark, str(path), header=False)[0].where("num_col = 'num_col'").count() == 1


def test_csv_round_trip(frame, spark, tmp_path):
    rows = {(' lead "q", 1', "tail "), ("back\\slash", "쉼,표"), ("1", ""), ("NA", "null")}
    pair_csv.write_pairs(frame(list(rows), SCHEMA), str(tmp_path / "out"))
    good, bad = pair_csv.read_pairs(spark, str(tmp_path / "out"))
    assert {tuple(r) for r in good.collect()} == rows and bad.isEmpty()


def test_splits_and_union(frame, spark, tmp_path):
    for name in "abc":
        pair_csv.write_pairs(frame([(name, "s")], SCHEMA), str(tmp_path / name))
    both = pair_csv.read_splits(
        spark, {"train": [str(tmp_path / "a"), str(tmp_path / "b")], "validation": [str(tmp_path / "c")]}
    )
    assert {(r.num_col, r.split) for r in both.collect()} == {("a", "train"), ("b", "train"), ("c", "validation")}
    mixed = pair_csv.union_all([frame([("1", "x")], SCHEMA), frame([("y",)], "sen_col string")])
    assert {tuple(r) for r in mixed.collect()} == {("1", "x"), (None, "y")}


def test_clean_csv_from_file_to_file(spark, frame, tmp_path):
    source, more, out = (str(tmp_path / n) for n in ("in.csv", "more.csv", "out"))
    with open(source, "w") as f:
        f.write('num_col,sen_col\n12,일이\n"3,a",나가\n3가,나\nonly\n1,2,3\n\n,x\n')
    with open(more, "w") as f:
        f.write('num_col,sen_col\n"a ""q""",a q\n')
    report = C.clean_csv(spark, [source, more], out)
    kept = {(r.num_col, r.sen_col) for r in pair_csv.read_pairs(spark, out)[0].collect()}
    assert kept == {("12", "일이"), ("3,a", "나가"), ('a "q"', "a q")}
    assert {(r.line, r.reason) for r in report["rejects"].collect()} == {("only", "too few fields"), ("1,2,3", "too many fields")}
    assert [tuple(r) for r in report["quarantine"].collect()] == [("", "x")]
    assert {r.verdict: r.n for r in report["sizes"].collect()} == {"keep": 3, "drop": 1, "quarantine": 1}
    profile = {(r.phase, r.series): (r.n, r.max) for r in report["profile"].collect()}
    assert profile[("before", "num")] == (5, 5) and profile[("after", "num")] == (3, 5) and profile[("after", "sen")] == (3, 3)
