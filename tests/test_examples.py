import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from dualscript.operators import examples as E
from dualscript.operators import lookup as L
from dualscript.operators import vocabulary as V
from dualscript.operators.lookup import balanced_lookup
from dualscript.sources import storage


@pytest.fixture(scope="module")
def pairs(frame):
    rows = [(0, "경제 1번지 b", "경제 일번지 b"), (1, "b b", "b b c"), (2, "", "")]
    return frame(rows, "pos int, num_col string, sen_col string")


@pytest.fixture(scope="module")
def vocab(pairs):
    return V.build_vocab(pairs, "num_col", "sen_col")


def first(df):
    return df.where("pos = 0").first().asDict()


def test_text_forms(pairs):
    num, sen = "경제 1번지 b", "경제 일번지 b"
    assert first(E.directed_examples(pairs, "NTT")) == {"pos": 0, "input": num, "label": sen}
    assert first(E.directed_examples(pairs, "TTN")) == {"pos": 0, "input": sen, "label": num}
    assert first(E.prompt_examples(pairs, "p")) == {"pos": 0, "input": f"p: {num}", "label": sen}
    text = f"<s>{sen}</s><s>{num}</s>"
    assert first(E.causal_examples(pairs, "TTN")) == {"pos": 0, "input": text, "label": text}
    with pytest.raises(ValueError):
        E.causal_examples(pairs, "other")


def test_vocabulary(vocab):
    rows = [tuple(r) for r in vocab.orderBy("id").collect()]
    assert rows == [
        (0, "<s>", 0), (1, "</s>", 0), (2, "<unk>", 0), (3, "<pad>", 0), (4, "<mask>", 0),
        (5, "b", 6), (6, "경제", 2), (7, "1번지", 1), (8, "c", 1), (9, "일번지", 1),
    ]


def test_encode_decode(frame, pairs, vocab):
    got = {r.pos: r for r in E.encoded_examples(E.directed_examples(pairs, "NTT"), "pos", vocab).collect()}
    assert (got[0].input_ids, got[0].labels, got[0].length) == ([6, 7, 5], [6, 9, 5, 1], 3)
    assert (got[2].input_ids, got[2].labels, got[2].length) == ([], [1], 0)
    cut = {r.pos: r for r in E.encoded_prompts(E.prompt_examples(pairs), "pos", vocab, 3).collect()}
    assert (cut[0].input_ids, cut[0].labels) == ([V.UNK, 6], [6, 9, 1])
    texts = V.decode(V.encode(pairs, "pos", "sen_col", vocab, add_eos=True), "pos", "ids", vocab)
    assert {r.pos: r.text for r in texts.collect()} == {0: "경제 일번지 b", 1: "b b c", 2: ""}


def test_lookup_scatters_answered_rows(spark):
    left = spark.range(9000).select(
        "id", F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 3 == 1, None)
        .otherwise(F.concat(F.lit("k"), "id")).alias("w"),
    )
    table = spark.range(9000).select(F.concat(F.lit("k"), "id").alias("w"), F.col("id").alias("v"), F.lit(1).alias("n"))
    table = table.unionByName(spark.createDataFrame([("hot", -1, 5000)], "w string, v bigint, n int"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        out = balanced_lookup(left, table, ["w"], "n", "id")
        plan = out._jdf.queryExecution().executedPlan().toString()
        assert "hashpartitioning(w" in plan and "_salt" in plan.split("hashpartitioning(w", 1)[1].split(")")[0]
        wrong = out.where(
            ~F.when(F.col("w").isNull(), F.col("v").isNull()).when(F.col("w") == "hot", F.col("v") == -1)
            .otherwise(F.col("v") == F.col("id"))
        )
        assert out.count() == 9000 and wrong.isEmpty()
        sizes = out.groupBy(F.spark_partition_id()).count().agg(F.max("count"))
        assert sizes.first()[0] < 4500
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def test_lookup_scatters_frequent_misses(spark):
    left = spark.range(20000).select(
        "id", F.when(F.col("id") % 2 == 0, "absent").otherwise(F.concat(F.lit("k"), F.col("id") % 5000)).alias("w"))
    table = spark.range(5000).select(F.concat(F.lit("k"), "id").alias("w"), F.col("id").alias("v"), F.lit(1).alias("n"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        out = balanced_lookup(left, table, ["w"], "n", "id", may_miss=True)
        right = F.when(F.col("w") == "absent", F.col("v").isNull()).otherwise(F.col("v") == F.col("id") % 5000)
        assert out.count() == 20000 and out.where(~F.coalesce(right, F.lit(False))).isEmpty()
        sizes = out.groupBy(F.spark_partition_id()).count().agg(F.max("count"), F.avg("count")).first()
        assert sizes[0] < 2 * sizes[1]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def test_length_buckets(spark):
    df = spark.range(100).select("id", F.repeat(F.lit("w "), (F.col("id") + 1).cast("int")).alias("t"))
    b = E.length_buckets(df, "t", 4)
    assert {r.bucket: r["count"] for r in b.groupBy("bucket").count().collect()} == {0: 25, 1: 25, 2: 25, 3: 25}
    laid = E.grouped_by_length(b, 4).withColumn("p", F.spark_partition_id())
    ranges = laid.groupBy("p").agg(F.min("length").alias("lo"), F.max("length").alias("hi")).orderBy("lo").collect()
    assert all(a.hi <= c.lo for a, c in zip(ranges, ranges[1:])) and laid.count() == 100


def greedy_batches(lengths, budget):
    """Rows in order of length, cut where the padded batch would exceed the budget."""
    out, now = [], []
    for n in sorted(lengths):
        if now and (len(now) + 1) * max(n, 1) > budget:
            out.append(now)
            now = []
        now.append(n)
    return out + [now] if now else out


@pytest.mark.parametrize("seed", range(40))
def test_batch_plan_is_the_greedy_one(seed):
    rng = random.Random(seed)
    lengths = [rng.choice([0, 1, 2, 3, 5, 8, 8, 8, rng.randrange(60)]) for _ in range(rng.randrange(1, 200))]
    budget = rng.choice([1, 7, 16, 50, 1000])
    got = {}
    for length, row, open_, joins, new, per in E._batch_plan(dict(Counter(lengths)), budget):
        for at in range(lengths.count(length)):
            got[row + at] = open_ if at < joins else new + (at - joins) // per
    assert [got[r] for r in sorted(got)] == [k for k, batch in enumerate(greedy_batches(lengths, budget)) for _ in batch]


def test_token_budget_batches(spark, frame):
    rng = random.Random(5)
    rows = [(k, "w " * rng.choice([0, 3, 3, 3, 3, rng.randrange(40)])) for k in range(700)] + [(900, None), (901, "w " * 500)]
    df = frame(rows, "id int, t string").withColumn("batch_", F.lit(1)).repartition(5)
    out = E.token_budget_batches(df, "t", "id", 100)
    got = out.collect()
    assert out.columns == ["id", "t", "batch_", "length", "batch", "place"] and len(got) == len(rows)
    by = {}
    for r in sorted(got, key=lambda r: r.place):
        by.setdefault(r.batch, []).append(max(r.length, 0))
    known = [len((t or "").split()) for _, t in rows]
    assert list(by) == sorted(by) and [by[k] for k in sorted(by)] == greedy_batches(known, 100)
    assert all(len(b) * max(b) <= 100 or len(b) == 1 for b in by.values())
    report = E.padding_report(out).first()
    padded = sum(len(b) * max(b) for b in by.values())
    assert (report.batches, report.rows, report.tokens, report.padded) == (len(by), len(rows), sum(known), padded)
    assert report.padding_share == pytest.approx(1 - sum(known) / padded)
    assert E.padding_report(E.token_budget_batches(df.limit(0), "t", "id", 100)).first().padding_share == 0


def test_causal_ids_keep_reserved_ids_to_themselves(frame):
    pairs = frame([(1, "a b", "x"), (2, "<s> a </s>", "<mask> z"), (3, "", "x")], "pos int, num_col string, sen_col string")
    vocab = V.build_vocab(frame([("a b x a",)], "t string"), "t")
    ids = {r.token: r.id for r in vocab.collect()}
    got = {r.pos: (r.input_ids, r.labels, r.length) for r in E.encoded_causal(pairs, "pos", E.TEXT_TO_NUM, vocab).collect()}
    a, b, x = ids["a"], ids["b"], ids["x"]
    want = {1: [0, x, 1, 0, a, b, 1], 2: [0, 2, 2, 1, 0, 2, a, 2, 1], 3: [0, x, 1, 0, 1]}
    assert got == {k: (v, v, len(v)) for k, v in want.items()}
    with pytest.raises(ValueError):
        E.encoded_causal(pairs, "pos", "both", vocab)


@pytest.mark.parametrize("threshold", ["10485760", "-1"])
def test_frequent_misses_do_not_meet(spark, threshold):
    """A lookup is right, and balanced, whether the table is broadcast or joined by shuffle."""
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    try:
        table = storage.materialise(spark.range(2000).select(F.col("id").alias("k"), (F.col("id") * 2).alias("v"), F.lit(1).alias("n")), "t")
        # 400 absent keys, each above the share, and a few present ones
        left = storage.materialise(spark.range(40_000).select("id", F.when(F.col("id") % 2 == 0, F.col("id") % 800 + 5000).otherwise(F.col("id") % 2000).alias("k")), "l")
        out = L.balanced_lookup(left, table, ["k"], "n", ["id"], may_miss=True)
        assert out.where("k < 2000 and v <> 2 * k or k >= 5000 and v is not null").count() == 0 and out.count() == 40_000
        if threshold == "-1":
            spark.conf.set("spark.sql.adaptive.enabled", "false")
            sizes = [r["count"] for r in out.groupBy(F.spark_partition_id()).count().collect()]
            assert max(sizes) <= 2 * 40_000 / 4
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_reuse_of_stored_examples(frame, spark, tmp_path):
    path, source, built = str(tmp_path / "ex"), str(tmp_path / "in"), []

    def build():
        built.append(1)
        return spark.read.parquet(source)

    def reuse(**parameters):
        return storage.materialise_or_reuse(spark, path, build, [source], parameters).count()

    frame([(1, "a")], "k int, v string").write.parquet(source)
    assert [reuse(), reuse()] == [1, 1] and built == [1]
    frame([(2, "b")], "k int, v string").write.mode("append").parquet(source)
    assert [reuse(), reuse()] == [2, 2] and built == [1, 1]
    assert reuse(side="x") == 2 and built == [1, 1, 1]
    assert len([p for p in (tmp_path / "ex").iterdir() if not p.name.startswith(".")]) == 1


def test_an_unfinished_table_is_not_read(frame, spark, tmp_path):
    path, source = tmp_path / "ex", str(tmp_path / "in")
    frame([(1,)], "k int").write.parquet(source)
    mark = storage.fingerprint(spark, [source])
    (path / f"_{mark}").mkdir(parents=True)  # a writer that died

    def build():
        # another writer of the same fingerprint finishes first
        if not (path / mark).exists():
            frame([(7,)], "k int").write.parquet(str(path / mark))
        return frame([(8,)], "k int")

    assert [r.k for r in storage.materialise_or_reuse(spark, str(path), build, [source]).collect()] == [7]


def test_shared_folder_is_the_configured_one(spark):
    assert storage.shared_dir(spark) == spark.conf.get("spark.checkpoint.dir")


def test_frequent_tokens_stay_with_their_text(spark, monkeypatch):
    """Above the broadcast threshold only rare tokens move; before, all did."""
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    rng = random.Random(5)
    rows = [(k, " ".join(rng.choices(["a", "b", "c", "d"], k=200) + [f"w{k}", f"w{k + 1}"]), "" if k % 3 else f"w{k} <s> a") for k in range(300)]
    df = spark.createDataFrame(rows, "k long, x string, y string")
    vocab = V.build_vocab(df, "x", "y")
    ids = {r.token: r.id for r in vocab.collect()}
    moved = []
    plain = L.balanced_lookup
    monkeypatch.setattr(L, "TOP_KEYS", 10)
    monkeypatch.setattr(L, "balanced_lookup", lambda left, *rest: moved.append(left) or plain(left, *rest))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "1")
    try:
        out = V.encode_texts(df, "k", {"p": "x", "r": "y"}, vocab).localCheckpoint()
        text = {r.k: (r.x, r.y) for r in V.decode_lists(out, "k", {"x": "p", "y": "r"}, vocab).collect()}
        rare = moved[0].count()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert {r.k: (r.p, r.r) for r in out.collect()} == {
        k: tuple([V.UNK if w == "<s>" else ids[w] for w in t.split()] for t in (x, y)) for k, x, y in rows}
    assert text == {k: (x, y.replace("<s> ", "")) for k, x, y in rows}
    assert 0 < rare <= 900
