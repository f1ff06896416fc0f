import random
from difflib import SequenceMatcher

from dualscript.functions.similarity import byte_ratio, lcs_length, ratio_at_most


def texts(rng, alphabet, longest):
    return "".join(rng.choice(alphabet) for _ in range(rng.randint(0, longest))).encode()


def test_ratio_is_difflib_with_autojunk():
    a = ("가나다라" * 20 + "1나").encode()
    b = ("나다라" + "가나다라" * 19 + "일다").encode()
    assert len(b) >= 200
    assert byte_ratio(a, b) == SequenceMatcher(None, list(a), list(b)).ratio() == 0.0
    assert byte_ratio(a, b, autojunk=False) > 0.9


def test_bounds_never_change_the_answer():
    rng = random.Random(5)
    for alphabet, longest in (("abc", 30), ("가나다라마바사 1", 90), ("abcdefghijklmnop", 260)):
        for _ in range(120):
            a, b = texts(rng, alphabet, longest), texts(rng, alphabet, longest)
            if rng.random() < 0.4:
                b = a[: rng.randint(0, len(a))] + b
            for limit in (0.1, 0.2, 0.4, 0.5):
                for junk in (True, False):
                    expected = SequenceMatcher(None, a, b, junk).ratio() <= limit
                    assert ratio_at_most(a, b, limit, junk) == expected


def test_lcs_against_table():
    rng = random.Random(9)
    for _ in range(200):
        a = [rng.choice("abcd") for _ in range(rng.randint(0, 70))]
        b = [rng.choice("abcd") for _ in range(rng.randint(0, 70))]
        previous = [0] * (len(b) + 1)
        for x in a:
            row = [0]
            for j, y in enumerate(b):
                row.append(previous[j] + 1 if x == y else max(previous[j + 1], row[j]))
            previous = row
        assert lcs_length(a, b) == previous[-1]


def test_rouge_holds_few_rows_in_python():
    import tracemalloc

    import pyarrow as pa

    from dualscript.functions import similarity as S

    n = 3000
    lines = [[[f"w{k % 7}_{i}" for i in range(20)], [f"x{k}"]] for k in range(n)]
    pred_lines = pa.array(lines)
    ref_lines = pa.array([x[::-1] if k % 3 else None for k, x in enumerate(lines)])
    whole = pa.array([sum(x, []) for x in lines])
    empty = pa.array([[] for _ in range(n)], pa.list_(pa.string()))
    got = S._rouge_lcs.func(whole, whole, pa.array([x if k % 3 else None for k, x in enumerate(lines)]), ref_lines).to_pylist()
    assert got == [{"rougeL": 1.0, "rougeLsum": 1.0}] * n
    tracemalloc.start()
    S._rouge_lcs.func(empty, empty, pred_lines, pred_lines.slice(0, n))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 4_000_000
