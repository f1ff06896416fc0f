import os

import pytest
from pyspark.sql import functions as F

from dualscript.operators import pairs as P
from dualscript.sources import trn
from dualscript.streaming import deltas, ingest

FILES = {
    "b_scripts/one.trn": "p :: (1)/(일) a\np :: (2)/(둘)\r\nno delimiter\np :: (1)/(하나) a",
    "a_scripts/two.trn": "p :: (2)/(이)\n",
    "other/three.trn": "p :: (9)/(구)\n",
}


def write(base, names):
    for name in names:
        path = base / name
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_text(FILES[name], newline="")


def found(df):
    return {(r.num_col, r.sen_col) for r in df.collect()}


def test_trn_scan_order_and_folders(spark, tmp_path):
    write(tmp_path, FILES)
    lines = trn.read_trn(spark, str(tmp_path))
    assert lines.count() == 5
    assert found(P.sentence_pairs(lines)) == {("1 a", "하나 a"), ("2", "둘")}
    halves = P.head_split(P.sentence_pairs(lines), 0.5)
    assert found(halves.where("split = 'valid'")) == {("2", "둘")}


def test_stream_equals_batch(spark, tmp_path):
    data, out, state = tmp_path / "data", str(tmp_path / "out"), str(tmp_path / "state")
    write(data, ["a_scripts/two.trn"])
    run = lambda: ingest.append_pairs(ingest.stream_trn(spark, str(data)), out, state).awaitTermination()
    run()
    assert found(ingest.read_appended(spark, out)) == {("2", "이")}
    write(data, ["b_scripts/one.trn"])
    run()
    batch = P.valid_pairs(trn.read_trn(spark, str(data)))
    pairs = lambda df: sorted(map(tuple, df.select("num_col", "sen_col").collect()))
    assert pairs(ingest.read_appended(spark, out)) == pairs(batch)


def many(base, n_files, n_lines):
    """Files in which keys come back within a file, across its blocks, and in other files."""
    for f in range(n_files):
        path = base / f"set{f % 2}_scripts" / f"{n_files - f:03d}.trn"
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_text("".join(f"p :: ({(k * 7 + f) % 90})/(f{f} l{k}) key\n" for k in range(n_lines)))


@pytest.mark.parametrize("n_files, per_trigger", [(3, 1), (20, 1)])
def test_dedup_over_many_triggers_and_blocks(spark, tmp_path, monkeypatch, n_files, per_trigger):
    monkeypatch.setattr(deltas, "FAN", 3)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "2k")  # a file is several blocks
    try:
        data, out, state = tmp_path / "data", str(tmp_path / "out"), str(tmp_path / "state")
        many(data, n_files, 400 if n_files == 3 else 40)
        lines = ingest.stream_trn(spark, str(data), files_per_trigger=per_trigger)
        assert "wholetext -> true" not in lines._jdf.queryExecution().logical().toString().lower()
        ingest.write_dedup(lines, out, state).awaitTermination()
        batch = P.sentence_pairs(trn.read_trn(spark, str(data)))
        order = lambda df: [(r.num_col, r.sen_col) for r in df.orderBy("pos").collect()]
        assert order(ingest.read_dedup(spark, out)) == order(batch)
        spans = deltas.live(deltas.ranges(spark, out))
        assert [s for a, b in spans for s in range(a, b + 1)] == list(range(n_files))
        assert n_files == 3 or len(spans) <= 6
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_replayed_batch_changes_nothing(spark, frame, tmp_path):
    out = str(tmp_path / "out")
    first, again = frame([(1,)], "x int"), frame([(2,)], "x int")
    assert deltas.publish(first, out, (0, 0)) and not deltas.publish(again, out, (0, 0))
    assert deltas.publish(frame([(3,)], "x int"), out, (1, 1))
    os.makedirs(f"{out}/_half-written")  # of a driver that died before the rename
    assert sorted(r.x for r in deltas.read(spark, out, first.schema).collect()) == [1, 3]
    assert deltas.publish(frame([(4,)], "x int"), out, (0, 1))
    assert not deltas.publish(again, out, (1, 1))
    assert [r.x for r in deltas.read(spark, out, first.schema).collect()] == [4]


def test_replaced_ranges_stay_for_readers_until_the_next_call(spark, frame, tmp_path, monkeypatch):
    monkeypatch.setattr(deltas, "FAN", 2)
    out, schema = str(tmp_path / "out"), frame([(1,)], "x int").schema
    total = lambda df: df.agg(F.sum("x").cast("int").alias("x"))
    for k in range(2):
        deltas.publish(frame([(k + 1,)], "x int"), out, (k, k))
    reader = deltas.read(spark, out, schema)
    deltas.compact(spark, out, total, schema, settled=[])
    assert sorted(r.x for r in reader.collect()) == [1, 2] and deltas.ranges(spark, out) == [(0, 0), (0, 1), (1, 1)]
    assert deltas.live(deltas.ranges(spark, out)) == [(0, 1)]
    deltas.compact(spark, out, total, schema, settled=deltas.ranges(spark, out))
    assert deltas.ranges(spark, out) == [(0, 1)] and [r.x for r in deltas.read(spark, out, schema).collect()] == [3]


def test_empty_stream_and_missing_table(spark, tmp_path):
    assert ingest.read_dedup(spark, str(tmp_path / "none")).count() == 0
    assert ingest.read_appended(spark, str(tmp_path / "none")).count() == 0
