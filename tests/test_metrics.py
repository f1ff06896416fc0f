import math
import random
from collections import Counter

import pytest

from dualscript.operators import metrics as M
from dualscript.sources import pair_csv


def bleu(rows):
    match, total, c, r = [0] * 4, [0] * 4, 0, 0
    for _, p, q in rows:
        p, q = p.split(), q.split()
        c, r = c + len(p), r + len(q)
        for n in range(1, 5):
            grams = lambda t: Counter(tuple(t[i:i + n]) for i in range(len(t) - n + 1))
            match[n - 1] += sum((grams(p) & grams(q)).values())
            total[n - 1] += max(len(p) - n + 1, 0)
    precisions = [m / t if t else 0.0 for m, t in zip(match, total)]
    geo = math.exp(sum(map(math.log, precisions)) / 4) if min(precisions) > 0 else 0.0
    bp = 1.0 if c > r else math.exp(1 - r / c)
    return {"bleu": geo * bp, "brevity_penalty": bp, "length_ratio": c / r,
            "translation_length": c, "reference_length": r}


def rouge(rows, n):
    def f1(p, q):
        grams = lambda t: Counter(tuple(t[i:i + n]) for i in range(len(t) - n + 1))
        a, b = grams(p.split()), grams(q.split())
        common = sum((a & b).values())
        return 2 * common / (sum(a.values()) + sum(b.values())) if common else 0.0

    return sum(f1(p, q) for _, p, q in rows) / len(rows)


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(1)
    out = [(0, "", "a b"), (1, "하나 둘", "하나 둘"), (2, "x", "")]
    for i in range(3, 40):
        ref = [rng.choice("가나다라마") for _ in range(rng.randint(1, 20))]
        pred = [w for w in ref if rng.random() < 0.85] + ["끝"] * rng.randint(0, 1)
        out.append((i, " ".join(pred), " ".join(ref)))
    return out


@pytest.fixture(scope="module")
def scored(frame, rows):
    return frame(rows, "id int, pred string, ref string")


def test_bleu(scored, rows):
    assert M.corpus_bleu(scored, ["id"]).first().asDict() == pytest.approx(bleu(rows))


def test_bleu_is_zero_without_long_matches(frame):
    got = M.corpus_bleu(frame([(1, "a b", "a c")], "id int, pred string, ref string"), ["id"]).first()
    assert (got.bleu, got.brevity_penalty) == (0.0, 1.0)


def test_rouge(scored, rows):
    got = M.rouge_n(scored, ["id"]).first()
    assert (got.rouge1, got.rouge2) == pytest.approx((rouge(rows, 1), rouge(rows, 2)))
    assert M.rouge_n_rows(scored, ["id"]).count() == len(rows)


def test_own_tokenizer(frame):
    from pyspark.sql import functions as F

    df = frame([(1, "a-b", "a-c")], "id int, pred string, ref string")
    assert M.rouge_n(df, ["id"], lambda c: F.split(c, "-")).first().rouge1 == 0.5


def table_places(ref, pred):
    """The matched places by the plain table and the same rule from the ends."""
    t = [[0] * (len(pred) + 1) for _ in range(len(ref) + 1)]
    for i, a in enumerate(ref):
        for j, b in enumerate(pred):
            t[i + 1][j + 1] = t[i][j] + 1 if a == b else max(t[i][j + 1], t[i + 1][j])
    i, j, out = len(ref), len(pred), set()
    while i and j:
        if ref[i - 1] == pred[j - 1]:
            i, j = i - 1, j - 1
            out.add(i)
        elif t[i][j - 1] > t[i - 1][j]:
            j -= 1
        else:
            i -= 1
    return out


def lsum(pred, ref):
    p, r = ([line.split() for line in x.split("\n") if line] for x in (pred, ref))
    cp, cr = (Counter(t for line in x for t in line) for x in (p, r))
    total, hits = sum(cp.values()) + sum(cr.values()), 0
    for line in r:
        for k in sorted(set().union(*[table_places(line, other) for other in p])):
            if cp[line[k]] and cr[line[k]]:
                cp[line[k]] -= 1
                cr[line[k]] -= 1
                hits += 1
    return 2 * hits / total if hits else 0.0


def test_rouge_lsum_goes_by_lines(frame):
    rng = random.Random(3)
    text = lambda: "\n".join(" ".join(rng.choice("abcde") for _ in range(rng.randrange(7))) for _ in range(rng.randrange(5)))
    rows = [(0, "b b\na a", "a a\nb b"), (1, "", "a\nb"), (2, "a\n", None), (3, "a b c", "a c"), (4, "\n\n", "\n")]
    rows += [(k, text(), text()) for k in range(5, 300)]
    got = {r.id: r for r in M.rouge_l_rows(frame(rows, "id int, pred string, ref string"), ["id"]).collect()}
    assert got[0].rougeLsum == 1.0 and got[0].rougeL == 0.5
    assert got[3].rougeLsum == got[3].rougeL
    for k, p, r in rows:
        assert got[k].rougeLsum == pytest.approx(lsum(p or "", r or "")), (p, r)


def test_evaluate_takes_tokenizers_and_scans_once(frame, spark, tmp_path):
    from pyspark.sql import functions as F

    frame([(1, "a-b\na", "a-c\na"), (2, "x", "x")], "id int, pred string, ref string").write.parquet(str(tmp_path / "t"))
    df = spark.read.parquet(str(tmp_path / "t"))
    by_dash = lambda c: F.split(c, "-")
    out = M.evaluate(df, ["id"], by_dash, by_dash)
    got = out.first()
    # "a", "b\na" against "a", "c\na"; by lines "a b" and "a" against "a c" and "a"
    assert got.rouge1 == got.rougeL == pytest.approx((0.5 + 1) / 2)
    assert got.rougeLsum == pytest.approx((2 / 3 + 1) / 2) and got.translation_length == 3 and got.predict_samples == 2
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1
    # one of the texts and one of the totals
    assert plan.count("Exchange hashpartitioning") == 1 and plan.count("Exchange SinglePartition") == 1


def test_metrics_of_nothing(frame):
    got = M.evaluate(frame([], "id int, pred string, ref string"), ["id"]).first()
    assert got.predict_samples == 0 and got.bleu == 0


def test_evaluate_and_save(scored, rows, spark, tmp_path):
    out = M.evaluate(scored, ["id"])
    pair_csv.write_metrics(out, str(tmp_path / "m"))
    saved = spark.read.json(str(tmp_path / "m")).first()
    assert saved.predict_samples == len(rows)
    assert saved.rougeL == saved.rougeLsum and saved.bleu == pytest.approx(bleu(rows)["bleu"])


def test_one_shuffle_before_the_totals(scored):
    plan = M.corpus_bleu(scored, ["id"])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1
