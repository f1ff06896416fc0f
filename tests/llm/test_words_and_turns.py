"""Spelling variants, SentencePiece and turn repair against brute force and the library."""

import hashlib
import heapq
import random
import re
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from pyspark.sql import functions as F

from dualscript.llm import piece_bpe, spelling, turn_repair
from dualscript.llm.queries import damaged, op11_spelling_variants, op12_sentencepiece, op13_turn_repair

MODEL = public_tokenizers.path("piece_bpe_32k.model")


# ---------------------------------------------------------------- spelling


def one_edit(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) - len(a) == 1 and any(b[:k] + b[k + 1:] == a for k in range(len(b)))


@pytest.mark.parametrize("seed", range(60))
def test_composed_machine_accepts_one_edit(seed):
    rng = random.Random(seed)
    words = sorted({(rng.randrange(3), "".join(rng.choice("abc") for _ in range(rng.randrange(6)))) for _ in range(rng.randrange(1, 60))})
    i, j = spelling.near_rows(np.array([g for g, _ in words]), spelling._matrix([w for _, w in words]))
    want = [(a, b) for a in range(len(words)) for b in range(a) if words[a][0] == words[b][0] and one_edit(words[a][1], words[b][1])]
    assert sorted(map(frozenset, zip(i.tolist(), j.tolist())), key=sorted) == sorted(map(frozenset, want), key=sorted)


def test_acceptor_is_minimal():
    chars = spelling._matrix(["abx", "aby", "cbx", "cby"])
    a = spelling.Acceptor.build(np.zeros(4, int), chars)
    assert len(a.final) == 4 and a.degree.sum() == 5  # start, after a or c, after b, end


def counted(rows, damage):
    out = Counter()
    for key, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if key is None else key}:{run}".encode())
            if damage and h % damage == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            out[run] += 1
    return {w: n for w, n in out.items() if len(w) >= 7 and n >= 2}


def grouped(words):
    near = {w: [v for v in words if v != w and one_edit(v, w)] for w in words}
    best = {w: min(near[w], key=lambda v: (-words[v], v)) for w in words if near[w]}
    form = {w: f for w, f in best.items() if words[f] >= 10 * words[w]}
    out = set()
    for w, n in words.items():
        root = w
        while root in form:
            root = form[root]
        out.add((w, n, len(near[w]), form.get(w), words[form[w]] if w in form else None, root))
    return out


def spelling_rows():
    rng = random.Random(4)
    text = ["variant " * 3000, "variants " * 200, "varjants " * 11, "varjantz " * 2, "aaaaaaaa " * 25, "aaaaaaa " * 2, "aaaaaaaaa " * 2,
            "ÉTUDIANT étudiant " * 3, "éTUDIANT " * 2, "x" * 20_000 + " " + "x" * 20_000, "Variant's-variant"]
    text += [" ".join("lettera" + "".join(rng.choice("abÿ") for _ in range(rng.randrange(4))) for _ in range(60)) for _ in range(6)]
    rows = [(k, t) for k, t in enumerate(text)] * 1 + [(3, text[3]), (None, "variant varient varient"), (70, None), (71, ""), (72, "a b 12")]
    return rows


@pytest.mark.parametrize("large", [spelling.LARGE, 3])
@pytest.mark.parametrize("damage", [None, 3])
def test_spelling_variants(spark, monkeypatch, large, damage):
    monkeypatch.setattr(spelling, "LARGE", large)
    rows = spelling_rows()
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("n", F.lit(1)).withColumn("word", F.lit("variant")).repartition(3)
    got = [tuple(r) for r in spelling.spelling_variants(docs, damage=damage).collect()]
    assert len(got) == len(set(got)) and set(got) == grouped(counted(rows, damage))
    if damage is None:
        roots = {r[0]: r[5] for r in got}
        assert roots["varjants"] == "variant" and roots["varjantz"] == "varjantz"


def test_no_words(spark):
    assert spelling.spelling_variants(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_op11_on_the_small_table(spark):
    sf = "/root/testdata/sf0.001"
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    got = {(r["word"], r["n"], r["n_near"], r["form"], r["form_n"], r["root"]) for r in op11_spelling_variants(spark, sf).collect()}
    assert got == grouped(counted(rows, 31))


# ---------------------------------------------------------------- sentencepiece


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=MODEL)


@pytest.fixture(scope="module")
def encoder(library):
    with open(MODEL, "rb") as f:
        return piece_bpe.Encoder(piece_bpe.PieceModel(f.read()))


ALPHABETS = ["abc ", "the anding  ", "aeiou ▁", "  \n\t", "éèêç ouan", "0123456789.,", "日本語テキスト", "😀\0<s>0xA ", "aab"]


@pytest.mark.parametrize("seed", range(20))
def test_ids_are_those_of_the_library(library, encoder, seed):
    rng = random.Random(seed)
    letters = ALPHABETS[seed % len(ALPHABETS)] + ALPHABETS[(seed * 7 + 3) % len(ALPHABETS)]
    texts = ["".join(rng.choice(letters) for _ in range(rng.randrange(80))) for _ in range(200)]
    assert [x.tolist() for x in encoder.encode(texts)] == library.encode(texts)


def test_long_and_odd_texts(library, encoder):
    rng = random.Random(0)
    texts = ["", " ", " " * 37, " " * 50_000 + "the", "x" * 100_000, "ab" * 3000, "".join(rng.choice("etaoinshr") for _ in range(20_000)),
             "the quick " * 30_000, "<s></s><0x0A>", "\n\r\t", "\U0010ffff"]
    assert [x.tolist() for x in encoder.encode(texts)] == library.encode(texts)
    assert encoder.model.run == 16


def test_memory_is_bounded(library, monkeypatch):
    monkeypatch.setattr(piece_bpe, "CACHE_WORDS", 50)
    monkeypatch.setattr(piece_bpe, "SLICE", 100)
    with open(MODEL, "rb") as f:
        small = piece_bpe.Encoder(piece_bpe.PieceModel(f.read()))
    texts = [f"word{k} " * 5 + "y" * 300 for k in range(100)]
    assert [x.tolist() for x in small.encode(texts)] == library.encode(texts)
    assert len(small.memory) < 120 and max(map(len, small.memory)) <= piece_bpe.CACHE_CHARS


def test_piece_ids_and_texts(docs, none, library):
    clash = docs.withColumn("decoded", F.lit(1))
    got = piece_bpe.piece_texts(piece_bpe.piece_ids(clash, MODEL), MODEL)
    assert set(got.columns) == {*clash.columns, "ids"}
    for r in got.collect():
        want = library.encode(r["text"] or "")
        assert r["ids"] == want and r["decoded"] == library.decode(want)
    assert piece_bpe.piece_ids(none, MODEL).count() == 0 and piece_bpe.piece_digests(none, MODEL).count() == 0


def test_op12_on_the_small_table(spark, library):
    sf = "/root/testdata/sf0.001"
    text = {r["doc_id"]: r["text"] or "" for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    for r in op12_sentencepiece(spark, sf).collect():
        ids = library.encode(text[r["doc_id"]])
        assert r["n_tokens"] == len(ids)
        assert r["ids_sha256"] == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert r["decoded_sha256"] == hashlib.sha256(library.decode(ids).encode()).hexdigest()


# ---------------------------------------------------------------- turns


STEP = {("0", "s"): "S", ("0", "u"): "U", ("S", "u"): "U", ("U", "a"): "E", ("E", "u"): "U"}
AFTER = {"0": "U", "S": "U", "U": "E", "E": "U"}


def cheapest(initials, go, truncated):
    """Uniform-cost search: cost, edits, and what is left as (row or None, new role or None)."""
    heap, seen = [(0, "", 0, "0", ())], set()
    while heap:
        cost, edits, i, q, out = heapq.heappop(heap)
        if (i, q) in seen:
            continue
        seen.add((i, q))
        if i == len(initials) and q in "0E":
            return cost, edits, out
        role = "assistant" if q == "U" else "user"
        heapq.heappush(heap, (cost + 2, edits + "I", i, AFTER[q], (*out, (-1, role))))
        if i < len(initials):
            heapq.heappush(heap, (cost + 3, edits + "D", i + 1, q, out))
            if not go[i]:
                if (q, initials[i]) in STEP:
                    heapq.heappush(heap, (cost + truncated[i], edits + "K", i + 1, STEP[q, initials[i]], (*out, (i, ""))))
                heapq.heappush(heap, (cost + 2 + truncated[i], edits + "R", i + 1, AFTER[q], (*out, (i, role))))


def repaired(rows):
    rows = sorted(rows, key=lambda r: (r[1] is not None, r[1] or 0, r[2], hashlib.md5(r[3].encode()).hexdigest()))
    seen, fault = set(), []
    for _, _, role, text in rows:
        bare = text.rstrip(" \t\n\x0b\x0c\r")
        fault.append("b" if not bare else "d" if (role, text) in seen else "t" if bare[-1] not in ".!?" else "")
        seen.add((role, text))
    initials = [r[2][:1] for r in rows]
    cost, edits, out = cheapest(initials, [f in ("b", "d") for f in fault], [int(f == "t") for f in fault])
    lines = "\n".join(f"{role or rows[i][2]}:{rows[i][3] if i >= 0 else ''}" for i, role in out)
    turns = [r[1] for r in rows if r[1] is not None]
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    return (gaps, fault.count("b"), fault.count("d"), fault.count("t"), sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:])),
            cost, edits, hashlib.sha256(lines.encode()).hexdigest())


def by_conversation(rows):
    out = {}
    for r in rows:
        out.setdefault(r[0], []).append(r)
    return {(c, *repaired(x)) for c, x in out.items()}


def random_turns(seed, n):
    rng = random.Random(seed)
    return [(rng.choice("uuaas x"), rng.random() < 0.2, rng.random() < 0.3) for _ in range(n)]


@pytest.mark.parametrize("seed", range(150))
def test_search_in_one_piece_and_in_fragments(seed):
    turns = random_turns(seed, seed % 14 + 1)
    want = cheapest(*zip(*turns))[:2]
    whole = turn_repair.Fragment("c", 0, whole=True)
    for t in turns:
        whole.row(*t)
    (way,) = whole.finished(ended=True)
    assert (way[4], way[6]) == want
    cuts = sorted(random.Random(seed).sample(range(1, len(turns)), min(len(turns) - 1, seed % 4)))
    ways = []
    for a, b in zip([0, *cuts], [*cuts, len(turns)]):
        part = turn_repair.Fragment("c", a, whole=False)
        for t in turns[a:b]:
            part.row(*t)
        ways += [dict(zip([n for n, _ in turn_repair._WAYS], (*w, False))) for w in part.finished(ended=False)]
    picked = turn_repair._choose(ways)
    edits = {(w["_begin"], w["_start"], w["_end"]): w["_edits"] for w in ways}
    assert (sum(p[5] for p in picked), "".join(edits[p[1:4]] + p[4] for p in picked)) == want


def test_survivors_emit_what_they_share():
    run, held = turn_repair.Survivors(turn_repair.NOTHING), 0
    for t in random_turns(1, 5000):
        run.row(*t)
        held = max(held, max(n.depth for _, n in run.at.values()) - run.root.depth)
    assert held < 60 and len(run.emitted) > 4900


def conversations():
    rng = random.Random(9)
    texts = ["Yes.", "No", "And then?", "", " \t", "One two three!", " ", "It ends here.  \n"]
    rows = [(c, t, rng.choice(["user", "assistant", "system", "tool"]), rng.choice(texts) + str(t) * (t % 2)) for c in range(40)
            for t in range(rng.randrange(1, 9))]
    rows += [(100, t, ["user", "assistant"][t % 2], f"Turn {t}.") for t in range(700)]  # a conversation over many blocks
    rows += [(None, 1, "user", "Who?"), (None, None, "assistant", "Me."), (101, None, None, None), (102, 3, "user", None), (102, 9, None, "x."),
             (103, 1, "user", "Same."), (103, 1, "user", "Same."), (103, 1, "assistant", "Same."), (104, 2**60, "s", "Big."),
             (105, 1, "user", "long text. " * 30_000)]
    return rows


@pytest.mark.parametrize("block", [turn_repair.BLOCK, 16])
def test_repair(spark, monkeypatch, block):
    monkeypatch.setattr(turn_repair, "BLOCK", block)
    rows = conversations()
    clashing = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("_c", F.lit(1)).withColumn("cost", F.lit(2))
    found = turn_repair.repair(clashing.repartition(3))
    plain = [(c, t, " " if r is None else r, " " if x is None else x) for c, t, r, x in rows]
    assert {tuple(r) for r in turn_repair.report(*found).collect()} == by_conversation(plain)
    kept = turn_repair.repaired_rows(found[0], found[2]).orderBy("_c", "_place").collect()
    initials = {}
    for r in kept:
        initials[r["_c"]] = initials.get(r["_c"], "") + r["_role"][0]
    assert all(re.fullmatch("(s?(ua)+)?", x) for x in initials.values())
    assert [r["_text"] for r in kept if r["_c"] == 100] == [f"Turn {t}." for t in range(700)]


def test_repair_of_string_keys_and_of_nothing(spark):
    rows = [("a", 1, "user", "Hi."), ("a", 2, "assistant", "Hello."), ("b", 1, "assistant", "Hello.")]
    table = spark.createDataFrame(rows, "conv_id string, turn int, role string, text string")
    assert {tuple(r) for r in turn_repair.report(*turn_repair.repair(table)).collect()} == by_conversation(rows)
    assert turn_repair.report(*turn_repair.repair(table.limit(0))).count() == 0


def test_op13_on_the_small_table(spark):
    sf = "/root/testdata/sf0.01"
    table = spark.read.parquet(f"{sf}/conversations.parquet")
    out = []
    for c, t, role, text in table.select("conv_id", "turn", "role", "text").collect():
        kind = zlib.crc32(f"{c}:{t}".encode()) % 20
        text, role = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text, "user" if kind == 4 else role
        out += [(c, t, role, text)] * (0 if kind == 0 else 2 if kind == 3 else 1)
    assert Counter(map(tuple, damaged(table).collect())) == Counter(out)
    got = {tuple(r) for r in op13_turn_repair(spark, sf).collect()}
    empty = hashlib.sha256(b"").hexdigest()
    assert got == by_conversation(out) | {(c, *[0] * 6, "", empty) for (c,) in table.select("conv_id").distinct().collect() if c not in {r[0] for r in out}}
