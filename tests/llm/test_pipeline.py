"""The pipeline stage by stage against plain Python on what the stage before it kept."""

import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from conftest import words
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from dualscript.llm import language_id, packing, quality_rules
from dualscript.llm.common import small_table

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    """The small tables with nulls, ties, repeated rows, copies and a column of an operator's name added."""
    base = str(tmp_path_factory.mktemp("tables"))
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    known = docs.where("lang is not null and length(text) > 1500").orderBy("doc_id").limit(4).collect()
    line = "A line of more than forty characters that six of the documents share."
    more = [(None, known[0]["text"]), (90_000, known[0]["text"]), (90_000, known[0]["text"]), (90_001, known[1]["text"] + "\nOne more line."),
            (90_002, None), (90_003, ""), (90_004, " \n\t")] + [(91_000 + k, f"{line}\n{known[2]['text']} {words(k, 30)}") for k in range(6)]
    extra = spark.createDataFrame([(i, t, "en", "x", 0 if t is None else len(t)) for i, t in more], docs.schema)
    docs.unionByName(extra).withColumn("kept", F.lit(1)).withColumn("_sig", F.lit("s")).repartition(3).write.parquet(f"{base}/documents.parquet")
    spark.read.parquet(f"{SMALL}/labels.parquet").write.parquet(f"{base}/labels.parquet")
    return base


def ids_and_texts(df):
    return Counter((r["doc_id"], r["text"]) for r in df.select("doc_id", "text").collect())


def key_of(line):
    return line.strip(" \t\n\x0b\x0c\r").translate({c: c + 32 for c in range(65, 91)})


def without_shared_lines(rows):
    holders = {}
    for i, t in rows:
        for k in map(key_of, (t or "").split("\n")):
            if len(k) >= 40 and i is not None:
                holders.setdefault(k, set()).add(i)
    shared = {k: max(v) for k, v in holders.items() if len(v) >= 5}
    assert shared
    return Counter(
        (i, "\n".join(x for x in (t or "").split("\n") if key_of(x) not in shared or shared[key_of(x)] == i)) for i, t in rows.elements())


def shingle_set(text):
    w = (text or "").translate({c: c + 32 for c in range(65, 91)}).replace("\x0b", " ").replace("\x0c", " ")
    w = [x for x in w.replace("\t", " ").replace("\n", " ").replace("\r", " ").split(" ") if x]
    return frozenset(tuple(w[k:k + 5]) for k in range(max(1, len(w) - 4))) if w else frozenset()


def one_of_each(rows):
    items = [(i, t, shingle_set(t)) for i, t in rows.elements()]
    root = list(range(len(items)))

    def find(k):
        while root[k] != k:
            k = root[k]
        return k

    for a in range(len(items)):
        for b in range(a):
            x, y = items[a][2], items[b][2]
            if x and y and 100 * len(x & y) >= 75 * len(x | y):
                root[find(a)] = find(b)
    groups = {}
    for k, (i, t, s) in enumerate(items):
        groups.setdefault(find(k) if s else ("blank", k), []).append((i is None, i or 0, i))
    return Counter(min(g)[2] for g in groups.values())


def test_each_stage_does_its_part(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    columns = docs.columns
    stages = dict(corpus_pipeline.STAGES)

    model = language_id.learn(docs.where(~language_id.held_out(F.col("doc_id"))))
    rejected = {r["_text"]: r["rejected"] for r in language_id.identify(docs, model).collect()}
    before = ids_and_texts(docs)
    now = stages["language_id"](spark, docs, folder)
    assert now.columns == columns
    assert ids_and_texts(now) == Counter({k: n for k, n in before.items() if not rejected[k[1]]})
    assert {None, "", " \n\t"}.isdisjoint({t for _, t in ids_and_texts(now)})

    kept = {r["_text"]: r["kept"] for r in quality_rules.judge(now, quality_rules.learn(now, spark.read.parquet(f"{folder}/labels.parquet"))).collect()}
    before = ids_and_texts(now)
    now = stages["quality_rules"](spark, now, folder)
    assert now.columns == columns and ids_and_texts(now) == Counter({k: n for k, n in before.items() if kept[k[1]]})

    before = ids_and_texts(now)
    now = stages["line_dedup"](spark, now, folder)
    assert now.columns == columns and ids_and_texts(now) == without_shared_lines(before)
    assert now.where("n_chars <> length(text)").count() == 0

    before = ids_and_texts(now)
    now = stages["near_dedup"](spark, now, folder)
    after = ids_and_texts(now)
    assert now.columns == columns and Counter(i for i, _ in after.elements()) == one_of_each(before) and not after - before

    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    want = Counter()
    for i, t in after.elements():
        ids = np.array([*tokenizer.encode(t or "", add_special_tokens=False).ids, 2], "<u4")
        start, size, piece = 0, len(ids) % 1024 or 1024, 0
        while start < len(ids):
            want[(i, piece, start, size, zlib.crc32(ids[start:start + size].tobytes()))] += 1
            start, size, piece = start + size, 1024, piece + 1
    packed = stages["packing"](spark, now, folder)
    names = ["doc_id", "piece", "start", "length", "ids_crc32"]
    assert Counter(map(tuple, packed.select(*names).collect())) == want
    whole = corpus_pipeline.run(spark, folder).collect()
    assert Counter(tuple(r[n] for n in names) for r in whole) == want
    used = {}
    for r in whole:
        used.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for places in used.values():
        places.sort()
        assert sum(n for _, n in places) <= 1024 and all(a + n == b for (a, n), (b, _) in zip(places, places[1:])) and places[0][0] == 0


def test_workers_hold_few_rows_and_words(spark):
    """Documents come in small batches, small tables start no Python worker, remembered words are bounded."""
    corpus_pipeline.prepare(spark)

    def sizes(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays([pa.array([b.num_rows]), pa.array([b.nbytes])], names=["n", "bytes"])

    wide = spark.range(0, 4000, 1, 1).select(F.concat(F.lit("x" * 20_000), "id").alias("t"))
    seen = wide.unionByName(spark.range(0, 4000, 1, 1).select(F.col("id").cast("string").alias("t"))).mapInArrow(sizes, "n long, bytes long")
    rows, most = seen.agg(F.max("n"), F.max("bytes")).first()
    assert rows == 1000 and most < 6 << 20

    table = small_table(spark, [("a", 1), (None, 2)], pa.schema([("s", pa.string()), ("n", pa.int64())]))
    plan = table._jdf.queryExecution().executedPlan().toString()
    assert "LocalTableScan" in plan and "ExistingRDD" not in plan
    assert [tuple(r) for r in table.collect()] == [("a", 1), (None, 2)] and small_table(spark, [], pa.schema([("n", pa.int64())])).count() == 0

    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    few = packing.WordIds(tokenizer, words=100)
    texts = [" ".join(f"{k}word{i}" for i in range(80)) for k in range(20)]
    for t in texts:
        assert few.ids(t) == np.array(tokenizer.encode(t, add_special_tokens=False).ids, "<u4").tobytes()
        assert len(few) <= 180


def test_pipeline_of_an_empty_table(spark, folder, tmp_path):
    spark.read.parquet(f"{folder}/documents.parquet").limit(0).write.parquet(f"{tmp_path}/documents.parquet")
    spark.read.parquet(f"{folder}/labels.parquet").write.parquet(f"{tmp_path}/labels.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
