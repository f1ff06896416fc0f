"""Operators that relate rows, pages and the pipeline, against brute force."""

import hashlib
import random
import time
import tracemalloc
from collections import Counter
from pathlib import Path
from urllib.parse import unquote

import numpy as np
import pytest
import zstandard
from conftest import edited, words
from pyspark.sql import functions as F

from dualscript.llm import common, embedding_dedup, html_crf, ngram_join, warc


def components(n, linked):
    root = list(range(n))
    def find(i):
        while root[i] != i:
            i = root[i]
        return i
    for i in range(n):
        for j in range(i):
            if linked(i, j):
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    return [find(i) for i in range(n)]


def smallest(ids, roots):
    best = {}
    for i, r in zip(ids, roots):
        if i is not None:
            best[r] = min(best.get(r, i), i)
    return [best.get(r) for r in roots]


def grams(t):
    w = (t or "").encode().lower().split()
    return {tuple(w[i:i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())


def check_join(df):
    rows = [(r["doc_id"], r["text"]) for r in df.collect()]
    sets = [grams(t) for _, t in rows]
    def linked(i, j):
        common_ = len(sets[i] & sets[j])
        return bool(sets[i]) and 100 * common_ >= 75 * len(sets[i] | sets[j])
    roots = components(len(rows), linked)
    low = smallest([i for i, _ in rows], roots)
    want = Counter((i, len(s), c if s else i) for (i, _), s, c in zip(rows, sets, low))
    assert Counter(map(tuple, ngram_join.jaccard_components(df).collect())) == want
    return roots, sets


def test_jaccard_components(docs, none):
    roots, sets = check_join(docs)
    kept = ngram_join.keep_one(docs)
    assert kept.columns == docs.columns
    assert kept.count() == len({r for r, s in zip(roots, sets) if s}) + sum(not s for s in sets)
    assert ngram_join.jaccard_components(none).count() == 0 and ngram_join.keep_one(none).count() == 0


@pytest.mark.parametrize("block, few", [(2, 64), (5, 2)])
def test_chains_of_near_copies(spark, monkeypatch, block, few):
    monkeypatch.setattr(ngram_join, "BLOCK", block)
    monkeypatch.setattr(ngram_join, "FEW", few)
    rng, texts = random.Random(5), []
    for family in range(6):
        t = words(family, rng.randrange(30, 90))
        for _ in range(12):
            texts.append(t)
            t = edited(rng.choice(texts[-5:]), rng.random(), rng.randrange(1, 4))
    texts += [words(3, 60)[:200] + " " + words(k, 25) for k in range(10)]
    check_join(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"))


def test_a_common_line_one_large_group_and_one_chain(spark, monkeypatch):
    """Tokens of many components go by tiles; nothing is lost and nothing joined that does not link."""
    monkeypatch.setattr(ngram_join, "FEW", 4)
    monkeypatch.setattr(ngram_join, "BLOCK", 8)
    line, base, texts = words(50, 30), words(51, 60), []
    texts += [line + " " + words(1000 + k, 4 + k % 12) for k in range(60)]
    texts += [edited(base, 2000 + k, 2 + k % 5) for k in range(60)]
    chain = words(52, 80)
    for k in range(25):
        chain = edited(chain, 3000 + k, 2)
        texts.append(chain)
    check_join(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"))


def test_sets_that_move_in_turns_lose_no_link(spark, monkeypatch):
    """Texts and sets move to their pairs a part at a time; each part's table is gone when its links are stored."""
    monkeypatch.setattr(ngram_join, "BLOCK", 4)
    monkeypatch.setattr(ngram_join, "FEW", 4)
    monkeypatch.setattr(ngram_join, "MOVED", 1)
    monkeypatch.setattr(ngram_join, "LEAST", 8)
    monkeypatch.setattr(ngram_join, "PORTIONS", 2)
    line, base = words(53, 30), words(54, 60)
    texts = [line + " " + words(4000 + k, 4 + k % 12) for k in range(20)] + [edited(base, 5000 + k, 2 + k % 5) for k in range(20)]
    made, stored = [], ngram_join.stored
    monkeypatch.setattr(ngram_join, "stored", lambda df, label, *spent: made.append((label, stored(df, label, *spent))) or made[-1][1])
    check_join(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"))
    at = lambda df: df.inputFiles()[:1]
    labels = [label for label, _ in made]
    assert labels.count("shingle-prefixes") == 2 and "block-bytes" in labels
    there = [label for label, df in made if at(df) and Path(unquote(at(df)[0].removeprefix("file:"))).exists()]
    assert not {"shingle-sets", "shingle-prefixes", "block-members", "block-documents", "rare-tokens"} & set(there)


def test_only_wanted_texts_move(spark):
    rows = [(None if k % 50 == 0 else k, k * 7, f"text {k}") for k in range(4000)]
    texts = spark.createDataFrame(rows, "_id long, _th long, _text string")
    needed = texts.where("_th % 280 = 0").select(F.col("_id").alias("_rid"), F.col("_th").alias("_rth"))
    got = {tuple(r) for r in ngram_join._marked(texts, needed).collect()}
    want = {r for r in rows if r[1] % 280 == 0}
    assert want <= got and len(got) < len(rows) / 4
    assert ngram_join._marked(texts, needed.where("false")).count() == 0


def test_a_stored_table_leaves_no_shuffle_files(spark):
    """At once, not after the next one: the disk held the shuffles of two jobs."""
    dirs = [Path(str(d)) for d in spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirs()]
    files = lambda: {f: f.stat().st_size for d in dirs for f in d.rglob("shuffle_*.data")}
    before = files()
    common.stored(spark.range(200_000).groupBy(F.xxhash64("id").alias("k")).count(), "released")
    for _ in range(40):
        left = {f: n for f, n in files().items() if f not in before and n > 1000}
        if not left:
            break
        time.sleep(0.1)
    assert not left


def test_connected_components(spark):
    rng = random.Random(2)
    edges = [(rng.randrange(60), rng.randrange(60)) for _ in range(40)] + [(i, i + 1) for i in range(100, 130)] + [(None, 3)]
    got = dict(map(tuple, common.connected_components(spark.createDataFrame(edges, "a int, b int"), "t").collect()))
    pairs = {frozenset(e) for e in edges if None not in e}
    nodes = sorted({n for e in edges if e[0] is not None and e[0] != e[1] for n in e})
    roots = components(len(nodes), lambda i, j: frozenset((nodes[i], nodes[j])) in pairs)
    assert got == {n: nodes[r] for n, r in zip(nodes, roots)}


def vectors():
    rng = np.random.default_rng(1)
    base = rng.normal(size=(40, 12))
    v = [*base, *(base[:15] + rng.normal(0, 0.1, (15, 12))), *(3.0 * base[:5]), *np.repeat(base[7:8], 9, axis=0)]
    rows = [(i, [float(c) for c in x], 0) for i, x in enumerate(v)]
    odd = [None, [], [0.0] * 12, [1.0, None] * 6, [float("nan")] * 12, [float("inf")] * 12, [1.0, 2.0], [2.0, 4.0]]
    return rows + [(200 + i, x, 1) for i, x in enumerate(odd)] + [(None, rows[3][1], 1), (3, rows[3][1], 0)]


@pytest.mark.parametrize("tile", [7, 2048])
def test_near_duplicate_vectors(spark, monkeypatch, tile):
    monkeypatch.setattr(embedding_dedup, "TILE", tile)
    monkeypatch.setattr(embedding_dedup, "STRIP", tile // 2)
    rows = vectors()
    def ok(x):
        return bool(x) and all(c is not None and np.isfinite(c) for c in x) and any(x)
    def linked(i, j):
        x, y = rows[i][1], rows[j][1]
        return ok(x) and ok(y) and len(x) == len(y) and np.dot(x, y) / np.sqrt(np.dot(x, x) * np.dot(y, y)) >= 0.95
    low = smallest([r[0] for r in rows], components(len(rows), linked))
    want = Counter((r[0], sum(linked(i, j) for j in range(len(rows)) if j != i), c if ok(r[1]) else r[0])
                   for i, (r, c) in enumerate(zip(rows, low)))
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    got = embedding_dedup.near_duplicates(df)
    assert Counter((r["vec_id"], r["n_links"], r["component_id"]) for r in got.collect()) == want
    assert got.where("kept <> (vec_id <=> component_id)").count() == 0
    assert embedding_dedup.near_duplicates(df.where("false")).count() == 0


@pytest.mark.parametrize("seed", range(30))
def test_parities_never_exceed_the_difference(seed):
    rng = random.Random(seed)
    base = [rng.getrandbits(64) for _ in range(rng.choice([1, 3, 31, 33, 64, 65, 300]))]
    a = np.unique(np.array(base + [rng.getrandbits(64) for _ in range(rng.randrange(20))], np.uint64))
    b = np.unique(np.array(base, np.uint64))
    bits = [ngram_join.parities(x).view("<u8") for x in (a, b)]
    assert all(2 * len(x) <= 64 * len(w) <= max(64, 4 * len(x)) for x, w in zip((a, b), bits))
    big, small = sorted(bits, key=len, reverse=True)
    while len(big) > len(small):
        big = big[:len(big) // 2] ^ big[len(big) // 2:]
    differ = sum(int(x).bit_count() for x in big ^ small)
    assert differ <= len(np.setxor1d(a, b))


def test_tiles_lose_no_pair():
    rng = np.random.default_rng(4)
    a = rng.normal(size=(200, 40))
    b = np.concatenate([a[:50] + rng.normal(0, 0.22, (50, 40)), rng.normal(size=(100, 40))])
    axes = np.linalg.qr(rng.normal(size=(40, 40)))[0]
    one, two = (embedding_dedup.Tile.of(np.arange(len(x)), np.ones(len(x), int), x, axes) for x in (a, b))
    parts = [embedding_dedup.linked_pairs(one, two, slice(k, k + 64)) for k in range(0, 200, 64)]
    i, j = (np.concatenate(x) for x in zip(*parts))
    cos = embedding_dedup.unit(a) @ embedding_dedup.unit(b).T
    assert set(zip(i.tolist(), j.tolist())) == set(zip(*map(list, np.nonzero(cos >= 0.95))))


@pytest.mark.parametrize("same", [True, False])
def test_dense_tiles_need_memory_by_their_rows(same):
    rng = np.random.default_rng(3)
    x = rng.normal(size=64) + rng.normal(0, 0.05, (embedding_dedup.TILE, 64))
    one, two = (embedding_dedup.Tile.of(np.arange(len(x)) + at, np.full(len(x), 2), x, np.eye(64)) for at in (0, 10_000))
    tracemalloc.start()
    out = embedding_dedup.tile_links(one, one if same else two)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    n = embedding_dedup.TILE
    assert peak < 100e6 and len(out) == (n if same else 2 * n) and len({p for _, p, _ in out}) == 1
    assert {k for _, _, k in out} == {2 * (n - 1) if same else 2 * n}


def test_tiles_keep_single_precision_where_it_is_exact():
    rng = np.random.default_rng(3)
    for x in (rng.normal(size=(5, 3)), rng.normal(size=(5, 3)).astype("f4").astype(float)):
        ids, copies, y = embedding_dedup._unpacked(embedding_dedup._packed(np.arange(5), np.arange(5) + 1, x))
        assert (ids == np.arange(5)).all() and (copies == np.arange(5) + 1).all() and (x == y).all()


PAGE = "<html><body>" + "<p>text of the page</p>" * 60 + "</body></html>"


@pytest.fixture(scope="module")
def pages(spark):
    rows = [(1, "http://a", PAGE), (5, "http://b\r\nX: y", PAGE), (3, None, PAGE), (None, "http://c", PAGE), (5, "http://d", PAGE),
            (7, "http://e", "short"), (8, "http://f", "short"), (9, "http://g", None), (10, "http://h", ""), (11, "http://i", "é" * 700),
            (12, "u", "<p>" + "x" * 3_000_000)] + [(100 + i, f"http://x/{i}", f"<p>{words(i, 200)}</p>") for i in range(60)]
    return spark.createDataFrame([(*r, "x", 1) for r in rows], "page_id long, url string, html string, record_type string, _id int")


def test_warc_round_trip(pages):
    got = warc.round_trip(pages).drop("url").collect()
    want, keeper = Counter(), {}
    rows = pages.collect()
    for r in rows:
        b = (r["html"] or "").encode()
        if len(b) >= 1000 and r["page_id"] is not None:
            keeper[b] = max(keeper.get(b, -1), r["page_id"])
    for r in rows:
        b = (r["html"] or "").encode()
        revisit = b in keeper and keeper[b] != r["page_id"]
        want[(r["page_id"], len(b), hashlib.sha1(b).hexdigest(), "revisit" if revisit else "response",
              keeper[b] if revisit else None, None if revisit else b)] += 1
    assert Counter((*tuple(r)[:5], None if r["payload"] is None else bytes(r["payload"])) for r in got) == want
    assert warc.round_trip(pages.where("false")).count() == 0


def archive(*records, dictionary=b""):
    extra = {"dict_data": zstandard.ZstdCompressionDict(dictionary)} if dictionary else {}
    c = zstandard.ZstdCompressor(**extra)
    return (warc.dictionary_frame(dictionary) if dictionary else b"") + b"".join(map(c.compress, records))


def test_archives_are_validated():
    one = warc.record(1, "http://a", b"payload", warc.sha1_of(b"payload"))
    dictionary = zstandard.train_dictionary(2048, [words(i, 300).encode() for i in range(60)]).as_bytes()
    data = archive(one, one, dictionary=dictionary)
    assert [r["payload"] for r in warc.read_archive(data)] == [b"payload"] * 2
    bad = [data[:-3], archive(one.replace(b"WARC/1.1", b"WARC/9")), archive(one.replace(b"payload\r\n\r\n", b"changed\r\n\r\n")),
           archive(one + b"x"), archive(one.replace(b"WARC-Type", b"WARC-Kind")), archive(one[:-1]), data[:10]]
    for b in bad:
        with pytest.raises(warc.WarcError):
            list(warc.read_archive(b))


def test_leaf_blocks():
    html = ("<!DOCTYPE html><head><title>t</title><style>p{}</style></head><body><div>a &amp; <b>b</b>\n c<p>d<br>e<p>f</div>"
            "<script>if (a < b) '</p>'</script><!-- x <p>y</p> --><ul><li>g<li>h</ul><textarea>z</textarea>i &lt;j&#233;")
    assert [b.text for b in html_crf.blocks_of(html)] == ["a & b c", "d e", "f", "g", "h", "i <jé"]
    assert html_crf.blocks_of("") == [] and [b.text for b in html_crf.blocks_of("<p>a<")] == ["a<"]


@pytest.mark.parametrize("start", ["<body>", "", "<body class=x><main>", "<span>x</span>", "x"])
def test_a_head_may_lack_its_end(start):
    head = "<!DOCTYPE html><html><head>\n<meta charset=utf-8><title>t</title><style>p{}</style>\n<link rel=x><script>1<2</script>\n"
    page = head + start + "<article><p>one<p>two</article></html>"
    want = ["x"] * ("x" in start[-8:] and "class" not in start) + ["one", "two"]
    assert [b.text for b in html_crf.blocks_of(page)] == want
    assert [b.text for b in html_crf.blocks_of(page.replace(start + "<article", "</head>" + start + "<article"))] == want
    assert "head" not in {t for b in html_crf.blocks_of(page) for t, _ in b.path}


@pytest.mark.parametrize("page, want", [
    ("<p>Thus <math><mrow><mi>x</mi><mo>=</mo><mfrac><mn>1</mn><mn>2</mn></mfrac></mrow></math> holds.", ["Thus x = 1 2 holds."]),
    ("<math><mi>a</mi><mspace/><mo>+</mo></math>", ["a +"]),
    *[(f"<div>a<{t}><p>b</p>c</{t}>d</div>", ["a", "b", "c", "d"])
      for t in ("noscript", "object", "iframe", "canvas", "audio", "video")],
    ("<div>a<svg><title>t</title><style>s</style><path d=''/><text>b</text></svg>c</div>", ["a", "b", "c"]),
    ("<div>a<button>b</button>c<select><option>d<option>e</select>f<textarea>g</textarea>h<template>i</template></div>",
     ["a", "c", "f", "h"]),
    ("<div>a<button><div>b</div></button>c</div>", ["a", "c"]),
    ("<div>a<button>b<p>c</p>d</div>e<button>f</button>g", ["a", "b", "c", "d", "e", "g"]),
    ("<div>a<button>b<p>c</p><button>d</button>e</div>", ["a", "b", "c", "e"]),
    ("<div>a<object>b<p>c</div>d", ["a", "b", "c", "d"]),
    ("<div>a<select><option>b<p>c</div>d", ["a", "c", "d"]),
    ("<div>a<textarea>b<p>c</div>d", ["a", "b", "c", "d"]),
    ("<head><noscript><link rel=x></noscript><title>t</title></head>a", ["a"]),
])
def test_only_named_parts_are_silent(page, want):
    assert [b.text for b in html_crf.blocks_of(page)] == want


@pytest.mark.parametrize("page, want", [
    ("Just some text.", "Just some text."), ("<html><body>One\n two &amp; three<br>four</body></html>", "One two & three four"),
    ("<html><head><title>t</title></head><body>Only text</body></html>", "Only text"), ("", ""), ("<script>x</script>", ""),
])
def test_text_without_elements_is_main(field, page, want):
    assert html_crf.main_text(page, field) == want


def test_fallback_text_of_an_article_is_main(field):
    t = "<p>Some long words of the story that go on for a while, as they do.</p>"
    page = f"<body><noscript><div class=notice>Please turn on scripts</div></noscript><article><h1>T</h1>{t}<noscript>{t}</noscript>{t}</article>"
    blocks = html_crf.blocks_of(page)
    assert field.decode(blocks) == [0, 1, 1, 1, 1]


@pytest.fixture(scope="module")
def field():
    return html_crf.train(html_crf.own_pages())


def test_field_on_pages_not_learned(field):
    right = total = 0
    for blocks, states in html_crf.own_pages(60, seed=99):
        right += sum(a == b for a, b in zip(field.decode(blocks), states))
        total += len(states)
    assert right > 0.97 * total


def test_field_is_trained_in_full(field, monkeypatch):
    def loss(model):
        out = 0.0
        for blocks, states in html_crf.own_pages():
            p, _ = html_crf.marginals(model.emissions(blocks), model.steps)
            out -= np.log(p[np.arange(len(states)), states] + 1e-300).sum()
        return out
    monkeypatch.setattr(html_crf, "EPOCHS", 10)
    short = loss(html_crf.train(html_crf.own_pages()))
    assert loss(field) < 0.9 * short


def test_extract(spark, field):
    page = ("<body><nav><ul><li><a href=/a>Home</a></li></ul></nav><div class=ad>Buy now.</div><article><h1>Title</h1>"
            "<p>First &amp; long paragraph of the article, with words.</p><p>Second one, it goes on.</p></article>"
            "<section class=comments><h2>Comments</h2><p>Nice post, thank you.</p></section><footer>© me</footer></body>")
    rows = [(1, "u", page), (1, "u", page), (2, None, None), (None, "v", ""), (3, "w", "<p>" * 50 + "x" * 100_000)]
    df = spark.createDataFrame([(*r, "t") for r in rows], "page_id long, url string, html string, text string")
    got = html_crf.extract(df, field).collect()
    text = "Title\nFirst & long paragraph of the article, with words.\nSecond one, it goes on."
    assert [r["text"] for r in got if r["page_id"] == 1] == [text, text]
    assert all(r["n_chars"] == len(r["text"]) for r in got) and len(got) == 5
    assert html_crf.extract(df.where("false"), field).count() == 0


def test_viterbi_and_marginals(field):
    import itertools
    blocks = html_crf.own_pages(1, seed=5)[0][0][:7]
    e, s = field.emissions(blocks), field.steps
    def score(y):
        return sum(e[i, k] for i, k in enumerate(y)) + sum(s[a, b] for a, b in zip(y, y[1:]))
    every = list(itertools.product((0, 1), repeat=len(blocks)))
    assert tuple(field.decode(blocks)) == max(every, key=score)
    w = np.exp([score(y) for y in every])
    p, moves = html_crf.marginals(e, s)
    assert np.allclose(p[:, 1], [sum(w[k] for k, y in enumerate(every) if y[i]) / w.sum() for i in range(len(blocks))])
    assert np.isclose(moves.sum(), len(blocks) - 1)


def test_pipeline_keeps_the_columns(spark):
    import corpus_pipeline as cp
    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    sizes = [docs.count()]
    for name, stage in cp.STAGES[:-1]:
        out = common.stored(stage(spark, docs, sf), f"t-{name}")
        assert out.columns == docs.columns and out.dtypes == docs.dtypes
        docs = out
        sizes.append(docs.count())
    assert sizes == sorted(sizes, reverse=True) and sizes[-1] > 0
    packed = cp.STAGES[-1][1](spark, docs, sf)
    assert packed.select("doc_id").distinct().count() == sizes[-1]
