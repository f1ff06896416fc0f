import random
import re

import pytest
from pyspark.sql import functions as F

from dualscript.functions import text as T
from dualscript.functions import arrays as A
from dualscript.functions.tokenize13a import tokens_13a


def apply(frame, fn, values):
    df = frame([(i, v) for i, v in enumerate(values)], "i int, s string")
    return [r[1] for r in df.select("i", fn(F.col("s")).alias("out")).orderBy("i").collect()]


def outside(text, bracket):
    """What stands where an even number of ``bracket`` has come before, without brackets."""
    return "".join(c for i, c in enumerate(text) if c not in "()" and text.count(bracket, 0, i) % 2 == 0)


@pytest.fixture(scope="module")
def bracket_strings():
    rng = random.Random(3)
    return ["".join(rng.choice("()ab1 /") for _ in range(rng.randint(0, 14))) for _ in range(400)]


def test_bracket_text_is_what_an_even_number_of_brackets_precedes(frame, bracket_strings):
    spelled = apply(frame, lambda c: T.bracket_text(c, "spelling"), bracket_strings)
    assert spelled == [outside(s, ")") for s in bracket_strings]
    spoken = apply(frame, lambda c: T.bracket_text(c, "phonetic"), bracket_strings)
    assert spoken == [None if s.count("(") % 2 else outside(s, "(") for s in bracket_strings]


def test_bracket_text_by_hand(frame):
    values = ["order (12)/(one two) ready", "(a)(b)c", "x)y(z", "((1)/(2)"]
    assert apply(frame, lambda c: T.bracket_text(c, "spelling"), values) == ["order 12 ready", "ac", "x", "1"]
    assert apply(frame, lambda c: T.bracket_text(c, "phonetic"), values) == ["order one two ready", "bc", None, None]


def test_stray_digit_equals_removal_then_search(frame, bracket_strings):
    got = apply(frame, T.has_stray_digit, bracket_strings)
    assert got == [bool(re.search(r"\d", re.sub(r"\([^)]*\)", "", s))) for s in bracket_strings]
    copied = apply(frame, lambda c: T.has_digit(T.drop_brackets(c)), bracket_strings)
    assert copied == got


def test_unknown_mode():
    with pytest.raises(ValueError, match="must be one of"):
        T.bracket_text(F.lit("x"), "other")


def test_symbols(frame):
    values = ["hello/ x", "oo/", "a # b", "a%b", " \t a\t\tb  c\td ", "[웃음]; 1,2 + *@$^&", "그래. 응? 네! ~"]
    assert apply(frame, lambda c: T.clean_symbols(c, "spelling"), values) == [
        "hell x", "o", "a 샾 b", "a%b", "a b c\td", "웃음 12", "그래. 응? 네! ~",
    ]
    strict = apply(frame, lambda c: T.clean_symbols(c, "phonetic"), values)
    assert strict[3] is None and strict[2] == "a 샾 b"
    assert apply(frame, lambda c: T.clean_symbols(c, "phonetic", " 퍼센트/"), ["5%"]) == ["5 퍼센트/"]


def test_whitespace_like_python(frame):
    values = ["　a   b\x1cc\x85", "", "   ", "x\ny", "​a"]
    assert apply(frame, T.tokens, values) == [v.split() for v in values]
    assert apply(frame, T.strip, values) == [v.strip() for v in values]
    assert apply(frame, T.is_blank, values) == [not v.strip() for v in values]
    assert len(T.WS_CHARS) == 29


def test_field_after(frame):
    values = ["p :: a :: b", "none", "p::", "::x"]
    assert apply(frame, lambda c: T.field_after(c, "::"), values) == [" a ", None, "", "x"]


def test_stride_pairs_leave_a_single_out(frame):
    got = apply(frame, lambda c: T.stride_pairs(T.bracket_list(c)), ["(a)(b)(c)", "x", "(1)/(일) (2)/(이)"])
    assert [[tuple(p) for p in row] for row in got] == [
        [("(a)", "(b)")], [], [("(1)", "(일)"), ("(2)", "(이)")],
    ]


def test_lengths_are_code_points(frame):
    assert apply(frame, F.length, ["𝄞a"]) == [2]
    assert apply(frame, lambda c: F.octet_length(T.utf8(c)), ["𝄞a"]) == [5]


def test_paths(frame):
    assert apply(frame, T.path_dir, ["/a/b/c.txt"]) == ["/a/b"]
    assert apply(frame, T.path_name, ["/a/b/c.txt"]) == ["c.txt"]


def test_arrays(spark):
    row = spark.range(1).select(
        A.fill_mask(F.array(F.lit(1), F.lit(-100)), 3).alias("mask"),
        A.arg_max_rows(F.array(F.array(F.lit(1.0), F.lit(9.0), F.lit(9.0)), F.array(F.lit(5.0), F.lit(2.0)))).alias("best"),
        A.append_id(F.array(F.lit(4)), 1).alias("ended"),
        A.drop_last(F.array(F.lit(4), F.lit(5))).alias("shorter"),
        A.drop_last(F.array().cast("array<int>")).alias("none"),
        A.truncate(F.array(F.lit(4), F.lit(5)), 1).alias("cut"),
        A.longer_grams(F.array(F.lit("a"), F.lit("b")), F.array(F.lit("a"), F.lit("b")), 2).alias("two"),
        A.longer_grams(F.array(F.lit("a")), F.array(F.lit("a")), 2).alias("few"),
    ).first()
    assert row.asDict() == {
        "mask": [1, 3], "best": [1, 0], "ended": [4, 1], "shorter": [4], "none": [], "cut": [4],
        "two": ["a b"], "few": [],
    }


def test_tokens_13a(frame):
    values = ["Hello, world. It's 3.5-4 &amp; 1,000!", "a-\nb <skipped>c", "", "x (y)"]
    assert apply(frame, tokens_13a, values) == [
        ["Hello", ",", "world", ".", "It's", "3.5", "-", "4", "&", "1,000", "!"],
        ["ab", "c"], [], ["x", "(", "y", ")"],
    ]
