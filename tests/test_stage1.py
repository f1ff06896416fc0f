"""Stage 1 from files: listing, hold-out, scripts in one file, many domains."""

import gzip
import random
import shutil

import pytest
from pyspark.sql import functions as F

from dualscript.functions import domains
from dualscript.operators import corpus as C
from dualscript.sources import tree

FILES = {
    "1.Training/1.방송/01/a.txt": "하나\r\n둘",
    "1.Training/1.방송/01/b.txt": "하나\n둘",
    "1.Training/1.방송/02/a.txt": "셋",
    "1.Training/2.취미/03/a.txt": "넷",
    "1.Training/2.취미/03/a.txt.bak": "다섯",
    "1.Training/2.취미/04/blank.txt": " 　\n",
    "1.Training/2.취미/05/only.wav": "소리",
    "1.Training/extra/06/a.txt": "다른 폴더",
    "2.Validation/1.방송/01/v.txt": "검증",
    "2.Validation/1.방송/02/w.txt": "가 먼저",
}


@pytest.fixture(scope="module")
def root(tmp_path_factory):
    base = tmp_path_factory.mktemp("my raw+tree")
    for name, text in FILES.items():
        path = base / name
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_bytes(text.encode())
    (base / "1.Training/1.방송/02/bad.txt").write_bytes(b"\xff\xfe broken")
    return base


def scenario(root, **changes):
    return C.Scenario("k", str(root), parent_glob="[0-9].*", child_glob="**/[0-9]*", **changes)


def test_listing_names_folders_without_opening_files(spark, root):
    files = tree.list_tree(spark, str(root), "1.Training", "[0-9].*", "**/[0-9]*")
    assert {(r.rel, r.file_name) for r in files.collect()} == {
        tuple(n.split("/", 1)[1].rsplit("/", 1)) for n in [*FILES, "1.Training/1.방송/02/bad.txt"] if n.startswith("1.") and "extra" not in n}
    assert files.where("file_name = 'a.txt' and rel like '%01'").first().n_bytes == len("하나\r\n둘".encode())
    plan = C.pick_dev_dirs(files, {"1.방송": 1}, "s", "rel")._jdf.queryExecution().executedPlan().toString()
    assert "content" not in plan and "text" not in plan.lower().replace("contexttext", "")
    assert "WindowGroupLimit" in plan


def test_a_folder_without_labels_can_be_held_out(spark, root):
    held = {r.rel for r in C.scenario_holdout(spark, scenario(root, quota={"2.취미": 3}), "x").collect()}
    assert held == {"2.취미/03", "2.취미/04", "2.취미/05"}


def test_files_of_held_folders_are_not_opened(spark, root):
    s = scenario(root)
    train = C.scenario_files(spark, s, tree.TRAIN, ["1.방송/01", "2.취미/03"])
    assert {r.rel for r in train.select("rel").collect()} == {"1.방송/02", "2.취미/04"}
    assert train.rdd.getNumPartitions() and len(train.select("path").collect()) == 3
    dev = C.scenario_files(spark, s, tree.DEV, ["1.방송/01"])
    assert {r.file_name for r in dev.collect()} == {"a.txt", "b.txt"}
    assert C.scenario_files(spark, s, tree.DEV, []).count() == 0


def whole(path):
    with open(path, "rb") as f:
        return f.read().decode()


def test_make_scripts(spark, root, tmp_path):
    other = C.Scenario("etri", str(root), vendor="한국전자통신연구원")
    scenarios = [scenario(root, quota={"1.방송": 1, "없음": 2}), other]
    out = str(tmp_path / "out")
    report = C.make_scripts(spark, scenarios, out, seed="x")
    (held,) = {r.rel for r in C.scenario_holdout(spark, scenarios[0], "x").collect()}
    texts = {"1.방송/01": ["하나\n둘"], "1.방송/02": ["셋"]}
    assert whole(f"{out}/dev.trn") == "\n".join(texts.pop(held))
    assert whole(f"{out}/train.trn") == "\n".join([*next(iter(texts.values())), "넷", "다섯"])
    n_train = 4 if held == "1.방송/02" else 3
    assert report["train"].first().asDict() == {"n_total": n_train, "n_unique": 3}
    assert {r.reason.split(":")[0] for r in report["rejected"].collect()} == {"vendor not supported", "not utf-8"}
    C.make_scripts(spark, scenarios, out, is_train=False)
    assert whole(f"{out}/eval.trn") == "검증\n가 먼저"


def test_make_scripts_without_dev(spark, root, tmp_path):
    report = C.make_scripts(spark, [scenario(root)], str(tmp_path))
    assert whole(f"{tmp_path}/dev.trn") == "" and report["dev"].first().asDict() == {"n_total": 0, "n_unique": 0}


def test_script_file_is_the_sorted_texts(spark, tmp_path):
    rng = random.Random(2)
    rows = [(k, rng.choice(["", "x", "é\nzwei", "long " * 500]) + str(k)) for k in range(3000)] + [(5000, "")]
    rng.shuffle(rows)
    path = str(tmp_path / "all.trn")
    for n in (10, 3001):  # replaced as a whole
        tree.write_script_file(spark.createDataFrame(rows[:n], "k int, text string").repartition(7), path, "k")
        assert whole(path) == "\n".join(t for _, t in sorted(rows[:n]))
    assert {p.name for p in tmp_path.iterdir() if not p.name.startswith(".")} == {"all.trn"}


@pytest.mark.parametrize("at_once", [domains.NAMES_AT_ONCE, 7])
def test_many_domains(frame, monkeypatch, at_once):
    monkeypatch.setattr(domains, "NAMES_AT_ONCE", at_once)
    rng = random.Random(1)
    word = lambda n: "".join(rng.choice("ab/é") for _ in range(n))
    names = sorted({word(rng.randint(1, 5)) for _ in range(80)})
    paths = [word(rng.randint(0, 12)) for _ in range(300)] + [None, "ß"]
    df = frame([(k, p) for k, p in enumerate(paths)], "k int, p string")
    got = {r.k: r.d for r in df.select("k", C.domain_of(F.col("p"), names).alias("d")).collect()}
    assert got == {k: None if p is None else min((n for n in names if n in p), default=None) for k, p in enumerate(paths)}
    few = df.select(C.domain_of(F.col("p"), ["", *names]).alias("d")).distinct().collect()
    assert {r.d for r in few} == {"", None}


def test_fifty_thousand_domains(frame):
    names = [f"d{k}-" for k in range(50_000)]
    df = frame([(f"/x/d{k}-/d{49_999 - k}-",) for k in range(200)], "p string")
    got = [r.d for r in df.select(C.domain_of(F.col("p"), names).alias("d")).collect()]
    assert got == [min(f"d{k}-", f"d{49_999 - k}-") for k in range(200)]


def test_files_under_their_names(spark, tmp_path):
    rows = [("a/b", "1.txt", "x\ny"), ("a/b", "2.wav", None), ("c=가 나", "3.txt", "z")]
    tree.write_files(spark.createDataFrame(rows, "dir string, file_name string, text string"), str(tmp_path / "t"))
    found = {str(p.relative_to(tmp_path / "t")): p.read_text() for p in (tmp_path / "t").rglob("*") if p.is_file()}
    assert found == {f"{d}/{n}": f"{t or ''}\n" for d, n, t in rows}


def test_small_files_share_tasks(spark, tmp_path):
    (tmp_path / "d" / "e").mkdir(parents=True)
    for k in range(640):
        (tmp_path / "d" / "e" / f"{k}.txt").write_text(f"{k}\n")
    for files in (tree.list_tree(spark, str(tmp_path)), tree.read_tree(spark, str(tmp_path))):
        assert files.count() == 640
        assert files.rdd.getNumPartitions() <= 4 * spark.sparkContext.defaultParallelism


def test_files_are_read_once(spark, root, tmp_path):
    copy = tmp_path / "copy"
    shutil.copytree(root, copy)
    report = C.make_scripts(spark, [scenario(copy)], str(tmp_path / "out"), seed="x")
    before = report["train"].first()
    copy.rename(tmp_path / "gone")  # the report needs no file any more
    assert before["n_total"] and report["train"].first() == before and report["rejected"].count() >= 0


def spark_scan(monkeypatch, read):
    """What Spark's own scans find, whose listing ends in the driver."""
    with monkeypatch.context() as m:
        m.setattr(tree, "_folder", lambda *_: None)
        return sorted(map(tuple, read().collect()))


def test_the_driver_lists_no_files(spark, tmp_path, monkeypatch):
    """Folders are listed and files opened in tasks, with the rows of Spark's own scans."""
    top = tmp_path / "raw + \u1112"
    for k in range(60):
        at = top / f"d{k % 5}" / "_x=1" / f"s {k % 7}"
        at.mkdir(parents=True, exist_ok=True)
        (at / f"{k}+ .txt").write_bytes(f"{k}\r\n\rx".encode())
    for name in ("d0/_hidden/a.txt", "d0/.dot/a.txt", "d0/_a.txt", "d0/.a.txt", "d0/b._COPYING_", "d0/_b=.txt", "d0/_metadata/m.txt", "d0/_metadata.txt",
                 "d1/empty.txt", "d1/bad.txt", "d1/bom.txt", "top.txt"):
        (top / name).parent.mkdir(parents=True, exist_ok=True)
        (top / name).write_bytes({"empty": b"", "bad": b"\xff\xfe\r", "bom": "\ufeffx".encode()}.get((top / name).stem, b"y"))
    (top / "nothing").mkdir()
    reads = [lambda: tree.list_tree(spark, str(top)), lambda: tree.list_tree(spark, str(top), None, "d[0-2]", "**"), lambda: tree.read_tree(spark, str(top)),
             lambda: tree.read_tree(spark, str(tmp_path), folder=top.name, child_glob="**", but_dirs=["d1"], name_contains=""),
             lambda: tree.read_tree(spark, str(top), parent_glob="_x=1", child_glob="s*", only_dirs=["d1/_x=1/s 1", "d2/_x=1/s 2"])]
    for read in reads:
        rows = sorted(map(tuple, read().collect()))
        assert rows == spark_scan(monkeypatch, read) and rows
        plan = read()._jdf.queryExecution().optimizedPlan().toString()
        assert "binaryFile" not in plan and "_metadata" not in plan
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        tree.read_tree(spark, str(top / "missing"))


def test_packed_files_are_unpacked(spark, tmp_path):
    at = tmp_path / "a" / "b"
    at.mkdir(parents=True)
    (at / "1.txt.gz").write_bytes(gzip.compress(b"one"))
    (at / "2.txt").write_bytes(b"two")
    assert {r.text for r in tree.read_tree(spark, str(tmp_path)).collect()} == {"one", "two"}
