"""Operators on single documents, against brute force."""

import hashlib
import re
import tracemalloc
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from conftest import words
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import AddedToken, Tokenizer

from dualscript.llm import byte_bpe, language_id, line_dedup, packing, quality_rules, token_counts

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
PACKER = public_tokenizers.path("byte_bpe_50k.json")
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def greedy(word, starts, others):
    at, n = 0, 0
    while at < len(word):
        pieces = starts if at == 0 else others
        size = next((k for k in range(len(word) - at, 0, -1) if word[at:at + k] in pieces), 0)
        if not size:
            if at == 0 and "" in starts and n == 0:
                starts, n = others, 1
                continue
            return None
        at, n = at + size, n + 1
    return n


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text("abc", max_size=4), max_size=8), st.lists(st.text("abc", min_size=1, max_size=4), max_size=8),
       st.text("abcd", min_size=1, max_size=12))
def test_automaton_is_greedy(starts, others, word):
    assert token_counts.build(starts, others).count(word) == greedy(word, set(starts), set(others))


def test_token_counts(docs, none):
    starts, others = {"w", "w1", ""}, {"1", "2", "23", "x", "0"}
    got = token_counts.token_counts(docs, sorted(starts), sorted(others))
    want = []
    for i, t in [(r["doc_id"], r["text"]) for r in docs.collect()]:
        found = [greedy(w, starts, others) for w in WORD.findall(t or "")]
        want.append((i, len(found), sum(1 if n is None else n for n in found), found.count(None)))
    assert Counter(map(tuple, got.collect())) == Counter(want)
    assert token_counts.token_counts(none, ["a"], ["a"]).count() == 0


def test_language_model_names_held_out_texts(spark, none):
    rows = [(i, " ".join(["the cat is on that mat", "el gato come en la casa"][i % 2].split()[k % 6] for k in range(i % 17 + 2)),
             ["en", "es"][i % 2]) for i in range(200)] + [(900, None, "en"), (901, "123 --", "es"), (902, "x", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = language_id.learn(docs.where(~language_id.held_out(F.col("doc_id"))))
    out = {r["_id"]: r for r in language_id.identify(docs, model).collect()}
    right = [out[i]["lang_pred"] == lang for i, _, lang in rows[:200]]
    assert np.mean(right) > 0.97
    assert out[900]["lang_pred"] == out[901]["lang_pred"] == "und" and out[901]["rejected"]
    assert all(0 <= r["score"] <= 1 for r in out.values())
    assert language_id.keep_known(docs, model).count() >= 190
    nothing = language_id.learn(none)
    assert language_id.identify(none, nothing).count() == 0
    assert nothing.predict("text")[0] == "und"


def test_learning_spells_out_a_step_at_a_time(spark):
    """The driver holds buckets and shares of the examples, not a row of all buckets for each."""
    docs = spark.createDataFrame([(i, words(i, 60) + (" der die das" if i % 2 else " the of and"), "de" if i % 2 else "en") for i in range(600)],
                                 "doc_id long, text string, lang string")
    tracemalloc.start()
    model = language_id.learn(docs, per_lang=300)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert model.langs == ("de", "en") and model.table.any()
    assert peak < 24 << 20  # all 1,800 examples as rows take 29 MB, and their copy for the fit 22
    at, share = language_id.averages(np.array([3, 9]), np.array([1, 3], np.float32))
    x = language_id.dense([(at, share), (at[:0], share[:0])])
    assert x.shape == (2, language_id.BUCKETS) and x[0, 3] == 0.25 and x[0, 9] == 0.75 and x.sum() == 1


def test_subword_counts_do_not_depend_on_the_pieces(monkeypatch):
    text = "Größe und Maß, été à l'île " * 50
    whole, _ = language_id.subword_counts(text)
    monkeypatch.setattr(language_id, "CHUNK", 97)
    pieces, _ = language_id.subword_counts(text)
    assert np.abs(whole - pieces).sum() < 0.1 * whole.sum()


def test_rejection_is_calibrated():
    rng = np.random.default_rng(0)
    y = rng.integers(0, 3, 3000)
    z = 4 * (np.eye(3)[y] + rng.normal(0, 0.6, (3000, 3)))
    t, floor = language_id.calibrate(z, y)
    p = language_id.softmax(z / t)
    assert abs(p.max(1).mean() - (p.argmax(1) == y).mean()) < 0.03
    assert (p.max(1)[p.argmax(1) == y] < floor).mean() <= 2 * language_id.MISS


def test_rejection_follows_the_right_answers():
    y = np.arange(4000) % 4
    z = 12.0 * np.eye(4)[y]
    z[::40] = 6.0 * np.eye(4)[(y[::40] + 1) % 4]  # wrong, and less certain than all that is right
    t, threshold = language_id.calibrate(z, y)
    p = language_id.softmax(z / t)
    right = p.argmax(1) == y
    assert threshold > 0.375 and (p.max(1)[~right] < threshold).all()
    assert (p.max(1)[right] < threshold).mean() <= language_id.MISS


@pytest.mark.parametrize("langs", [["en"], ["en", "es"]])
def test_nothing_held_out_rejects_no_lettered_text(spark, langs):
    rows = [(i, "the cat is on that mat" if lang == "en" else "el gato come en la casa", lang) for i in range(3) for lang in langs]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = language_id.learn(docs)
    assert model.threshold < 1
    assert language_id.keep_known(docs, model).count() == len(rows)


REMEMBERED = packing.WordIds(packing._tokenizer(open(PACKER, encoding="utf-8").read()))
ODD = st.text(st.sampled_from("ab1é' \n\t .!#<|>　😀s"), max_size=60)


@settings(max_examples=200, deadline=None)
@given(ODD)
def test_parts_are_encoded_alike_alone(text):
    t = Tokenizer.from_file(PACKER)
    t.encode_special_tokens = True
    parts = packing.parts_of(text)
    assert "".join(parts) == text
    alone = [i for p in parts for i in t.encode(p, add_special_tokens=False).ids]
    assert alone == t.encode(text, add_special_tokens=False).ids


@settings(max_examples=100, deadline=None)
@given(st.lists(ODD, max_size=4))
def test_remembered_ids_are_those_of_whole_texts(texts):
    ids = REMEMBERED  # what earlier examples left in it must not matter
    for text in texts + texts:
        want = ids.tokenizer.encode(text, add_special_tokens=False).ids
        assert np.frombuffer(ids.ids(text), "<u4").tolist() == want


ADDED = st.lists(st.one_of(ODD, st.sampled_from(["<|endoftext|>", "<|endoftext", "<|", " <|endoftext|> "])), max_size=6)


@settings(max_examples=200, deadline=None)
@given(ADDED)
def test_added_tokens_keep_their_id(parts):
    t, text = Tokenizer.from_file(PACKER), "".join(parts)
    got = np.frombuffer(REMEMBERED.ids(text), "<u4").tolist()
    assert got == t.encode(text, add_special_tokens=False).ids
    assert got.count(50256) == text.count("<|endoftext|>")


class Watched(packing.WordIds):
    """Counts lookups and notes what goes through the tokenizer."""

    def __init__(self, *args, **named):
        self.looked, self.sent = 0, []
        super().__init__(*args, **named)

    def __getitem__(self, word):
        self.looked += 1
        return super().__getitem__(word)

    def _encode(self, text):
        self.sent.append(text)
        return super()._encode(text)


def test_a_word_is_looked_up_and_encoded_once_for_many_texts():
    t = Tokenizer.from_file(PACKER)
    texts = ["the cat, the dog\nthe cat", None, "", "a  b", "<|endoftext|>the cat"] + ["dog the\ncat"] * 500
    ids = Watched(t)
    ids.sent.clear()
    got = [np.frombuffer(raw, "<u4").tolist() for raw in ids.batch(texts)]
    assert got == [t.encode(text or "", add_special_tokens=False).ids for text in texts]
    assert ids.looked < 30
    words = {" cat,", " the", " dog", "\nthe", " cat", "\ndog", "\ncat"}
    sent = [w for w in words if any(w in s for s in ids.sent)]
    assert set(sent) == words and sum(map(len, ids.sent)) <= sum(map(len, words)) + 40


def test_tokens_over_two_words_do_not_shift_remembered_ids():
    t = Tokenizer.from_file(PACKER)
    t.add_tokens([AddedToken("o w", normalized=False)])
    ids = packing.WordIds(t)
    words = {f"hello{k}o" for k in range(50)} | {f"w{k}orld" for k in range(50)}
    ids._learn(words)
    for w in words:
        assert ids[w] == np.array(t.encode(" " + w, add_special_tokens=False).ids, "<u4").tobytes()


def test_frequent_words_outlive_the_bound_of_the_memory():
    t = Tokenizer.from_file(PACKER)
    ids = Watched(t, words=40)
    for k in range(20):
        text = " ".join(["frequent"] + [f"{k}rare{i}" for i in range(15)] + ["frequent"])
        assert ids.ids(text) == np.array(t.encode(text, add_special_tokens=False).ids, "<u4").tobytes()
        assert len(ids) <= 40
    assert sum(" frequent" in s for s in ids.sent) == 1


@settings(max_examples=200, deadline=None)
@given(ODD, st.integers(1, 9))
def test_safe_pieces_change_no_id(text, size):
    enc = byte_bpe._encoding(open(RANKS, "rb").read(), public_tokenizers.PATTERN)
    parts = list(byte_bpe.safe_pieces(text, size))
    assert "".join(parts) == text
    assert [i for p in parts for i in enc.encode_ordinary(p)] == enc.encode_ordinary(text)


def test_bpe_round_trip(docs, none):
    got = byte_bpe.bpe_digests(docs, RANKS, public_tokenizers.PATTERN).collect()
    enc = byte_bpe._encoding(open(RANKS, "rb").read(), public_tokenizers.PATTERN)
    want = Counter()
    for r in docs.collect():
        t = r["text"] or ""
        ids = np.array(enc.encode_ordinary(t), "<u4")
        want[(r["doc_id"], len(ids), hashlib.sha256(ids.tobytes()).hexdigest(), hashlib.sha256(t.encode()).hexdigest())] += 1
    assert Counter(map(tuple, got)) == want
    assert byte_bpe.bpe_digests(none, RANKS, public_tokenizers.PATTERN).count() == 0
    ids = byte_bpe.bpe_ids(docs.where("doc_id = 0"), RANKS, public_tokenizers.PATTERN)
    back = byte_bpe.bpe_texts(ids, RANKS, public_tokenizers.PATTERN).first()["decoded"]
    assert bytes(back).decode() == docs.where("doc_id = 0").first()["text"]


def test_packing_is_gapless_and_tight(docs, none):
    got = packing.pack_documents(docs, PACKER).toPandas()
    t = Tokenizer.from_file(PACKER)
    want = []
    for r in docs.collect():
        ids = t.encode(r["text"] or "", add_special_tokens=False).ids + [2]
        cuts = [0, *range(len(ids) % 1024 or 1024, len(ids) + 1, 1024)]
        want += [(r["doc_id"], k, a, b - a, zlib.crc32(np.array(ids[a:b], "<u4").tobytes()))
                 for k, (a, b) in enumerate(zip(cuts, cuts[1:]))]
    cols = ["doc_id", "piece", "start", "length", "ids_crc32"]
    assert Counter(str(tuple(int(v) if v == v else None for v in r)) for r in got[cols].to_numpy(float)) == Counter(map(str, want))
    by = got.sort_values(["sequence_id", "offset"]).groupby("sequence_id")
    assert (got.sort_values(["sequence_id", "offset"])["offset"] == by["length"].cumsum() - got.sort_values(["sequence_id", "offset"])["length"]).all()
    assert by["length"].sum().max() <= 1024
    assert len(by) <= -(-got["length"].sum() // 1024) + 1
    assert packing.pack_documents(none, PACKER).count() == 0


@pytest.mark.parametrize("scale", [1, 1000])
def test_patterns_fill_sequences(scale):
    rng = np.random.default_rng(3)
    h = np.concatenate([[0], rng.multinomial(3000 * scale, rng.dirichlet(np.ones(1023))), [50]])
    bins = packing.plan(h)
    found = Counter()
    for b in bins:
        assert b.space >= 0
        for n in b.lengths:
            found[n] += b.times
    assert found == Counter({n: int(c) for n, c in enumerate(h) if c})
    total = int((h * np.arange(1025)).sum())
    assert sum(b.times for b in bins) <= 1.006 * total / 1024 + 2


def test_shared_lines(docs, none):
    rows = docs.collect()
    key = lambda line: line.strip(" \t\n\x0b\x0c\r").translate({c: c + 32 for c in range(65, 91)})
    holders = {}
    for r in rows:
        for line in (r["text"] or "").split("\n"):
            if len(key(line)) >= 40 and r["doc_id"] is not None:
                holders.setdefault(key(line), set()).add(r["doc_id"])
    shared = {k: max(v) for k, v in holders.items() if len(v) >= 5}
    want = Counter()
    for r in rows:
        lines = (r["text"] or "").split("\n")
        left = [x for x in lines if key(x) not in shared or shared[key(x)] == r["doc_id"]]
        want[(r["doc_id"], len(lines), len(lines) - len(left), "\n".join(left))] += 1
    assert shared
    got = line_dedup.shared_lines(docs).select("_id", "n_lines", "n_dropped", F.coalesce("kept_text", F.lit("")))
    assert Counter(map(tuple, got.collect())) == want
    out = line_dedup.drop_shared_lines(docs)
    assert out.columns == docs.columns and out.count() == len(rows)
    assert line_dedup.shared_lines(none).count() == 0


def test_statistics(docs, none):
    def brute(t):
        w = WORD.findall(t or "")
        windows = Counter(zip(w, w[1:], w[2:]))
        inside = {i + k for i in range(len(w) - 2) if windows[tuple(w[i:i + 3])] > 1 for k in range(3)}
        lines = [x for x in (t or "").split("\n") if WORD.search(x)]
        return len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in t or ""), len(lines) - len(set(lines)), len(inside)
    texts = ["a b c a b c a b", "a a a a", "x\nx\n\n\ny # <|>", "a b c d a b c", None, ""]
    df = docs.select("doc_id", "text").unionByName(docs.sparkSession.createDataFrame([(500 + i, t) for i, t in enumerate(texts)], "doc_id long, text string"))
    got = quality_rules.judge(df, []).select("_text", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept").collect()
    for r in got:
        want = brute(r["_text"])
        assert tuple(r)[1:6] == want
        assert r["base_failed"] == (want[0] < 50 or 100 * want[4] > 50 * want[0]) and r["kept"] == (not r["base_failed"])
    assert quality_rules.judge(none, []).count() == 0


def test_learned_list(spark, docs):
    rng = np.random.default_rng(0)
    x = {k: rng.random(1200) for k in quality_rules.STATISTICS}
    bad = (x["symbol_share"] > 0.8) | ((x["upper_share"] > 0.7) & (x["mean_word"] < 0.5))
    rules = quality_rules.cover(x, bad)
    hit = np.zeros(1200, bool)
    for r in rules:
        hit |= quality_rules._covered(r, x, 1200)
    assert (hit == bad).mean() > 0.97 and (hit & ~bad).sum() <= 0.03 * hit.sum()
    df = spark.createDataFrame([tuple(float(x[k][i]) for k in x) for i in range(1200)], list(x))
    assert [not r[0] for r in df.select(quality_rules.verdict(rules)).collect()] == hit.tolist()
    labels = spark.createDataFrame([(0, 1), (None, 0), (1, None)], "doc_id long, quality int")
    assert quality_rules.learn(docs, labels) == [] == quality_rules.learn(docs, labels.where("false"))
    assert quality_rules.keep_good(docs, labels).columns == docs.columns
