import pytest
from pyspark.sql import functions as F

from dualscript.operators import corpus as C
from dualscript.sources import tree

QUOTA = {"1.방송": 1, "2.취미": 2, "9.없음": 1}


@pytest.fixture(scope="module")
def root(tmp_path_factory):
    base = tmp_path_factory.mktemp("raw")
    files = {
        "1.Training/1.방송/01/a.txt": "하나\r\n둘",
        "1.Training/1.방송/01/b.txt": "하나\n둘",
        "1.Training/1.방송/02/a.txt": "셋",
        "1.Training/2.취미/03/a.txt": "넷",
        "1.Training/2.취미/03/a.txt.bak": "다섯",
        "1.Training/2.취미/03/a.wav": "소리",
        "1.Training/2.취미/04/blank.txt": " 　\n",
        "1.Training/2.취미/05/x y+z.txt": "여섯",
        "1.Training/extra/06/a.txt": "다른 폴더",
        "2.Validation/1.방송/01/v.txt": "검증",
    }
    for name, text in files.items():
        path = base / name
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_bytes(text.encode())
    (base / "1.Training/1.방송/02/bad.txt").write_bytes(b"\xff\xfe broken")
    return str(base)


@pytest.fixture(scope="module")
def files(spark, root):
    both = [tree.read_tree(spark, root, "[0-9].*", "**/[0-9]*", folder=f) for f in tree.SPLIT_FOLDERS.values()]
    return both[0].unionByName(both[1])


def names(df):
    return {r.path.split("/raw", 1)[1].split("/", 1)[1] for r in df.select("path").collect()}


def test_tree_scan(files):
    good, bad = tree.quarantine(files)
    assert names(bad) == {"1.Training/1.방송/02/bad.txt"}
    assert names(good) == {
        "1.Training/1.방송/01/a.txt", "1.Training/1.방송/01/b.txt", "1.Training/1.방송/02/a.txt",
        "1.Training/2.취미/03/a.txt", "1.Training/2.취미/03/a.txt.bak", "1.Training/2.취미/04/blank.txt",
        "1.Training/2.취미/05/x y+z.txt", "2.Validation/1.방송/01/v.txt",
    }
    assert good.where("file_name = 'a.txt' AND text = '하나\n둘'").count() == 1


def test_split_label_and_dedup(spark, files, tmp_path):
    train = C.label_files(tree.select_split(tree.quarantine(files)[0], True))
    assert train.count() == 6
    counts = C.script_counts(train).first()
    assert (counts.n_total, counts.n_unique) == (6, 5)
    tree.write_scripts(C.unique_scripts(train), str(tmp_path / "train.trn"))
    lines = {r.value for r in spark.read.text(str(tmp_path / "train.trn")).collect()}
    assert lines == {"하나", "둘", "셋", "넷", "다섯", "여섯"}
    assert C.unique_scripts(C.label_files(tree.select_split(files.where("valid"), False))).count() == 1


def test_hold_out_partitions_directories(files):
    train_dirs = C.label_files(tree.select_split(files.where("valid"), True))
    held = C.pick_dev_dirs(train_dirs, QUOTA, "s")
    picked = {(r.domain, r.dir) for r in held.collect()}
    assert sorted(d for d, _ in picked) == ["1.방송", "2.취미", "2.취미"]
    dev, train = C.dev_files(train_dirs, held, QUOTA), C.train_files(train_dirs, held, QUOTA)
    dirs = lambda df: {r.dir for r in df.select("dir").collect()}
    assert dirs(dev) == {d for _, d in picked}
    assert dirs(dev) | dirs(train) == dirs(train_dirs) and not dirs(dev) & dirs(train)
    both = C.split_files(train_dirs, held, QUOTA)
    assert both.where("split = 'dev'").count() == dev.count()
    short = {r.domain: (r.n_dev, r.n_found) for r in C.quota_shortage(held, QUOTA).collect()}
    assert short == {"9.없음": (1, 0)}


def test_hold_out_of_a_dominant_domain(spark, monkeypatch):
    df = spark.range(4000).select(
        F.concat(F.lit("/r/"), F.when(F.col("id") % 3 < 2, "big").otherwise("small"), F.lit("/"), "id").alias("dir")
    )
    quota = {"big": 500, "small": 3}
    picked = C.pick_dev_dirs(df, quota, "x")
    monkeypatch.setattr(C, "SALTS", 1)
    assert picked.count() == 503
    assert picked.exceptAll(C.pick_dev_dirs(df, quota, "x")).isEmpty()


def test_domain_is_the_smallest_match(frame):
    df = frame([("/x/src11/a",), ("/x/src1/b",), ("/x/none",)], "dir string")
    got = [r[0] for r in df.select(C.domain_of(F.col("dir"), ["src11", "src1"])).collect()]
    assert got == ["src1", "src1", None]


def test_domain_lists_are_bounded(spark):
    df = spark.range(500).select(F.concat(F.lit("/d1/"), "id").alias("dir"))
    lists = C.domain_dir_lists(df, ["d1"], list_size=50).collect()
    assert sorted(d for r in lists for d in r.dirs) == sorted(f"/d1/{i}" for i in range(500))
    assert len(lists) == 10 and max(len(r.dirs) for r in lists) < 100
    assert all(r.dirs == sorted(r.dirs) for r in lists)


def test_vendor_gate(frame):
    df = frame([("a", "솔루게이트"), ("b", "한국전자통신연구원"), ("c", None)], "scenario string, vendor string")
    got = {r.scenario: (r.accepted, r.reason) for r in C.gate_vendors(df).collect()}
    assert got["a"] == (True, None) and got["b"][0] is False and got["c"][0] is False
    assert got["b"][1].endswith("한국전자통신연구원")


@pytest.mark.parametrize("parent, child, path, hit", [
    ("[0-9].*", "**/[0-9]*", "1.x/sub/07", True),
    ("[0-9].*", "**/[0-9]*", "deep/1.x/07", True),
    ("[0-9].*", "**/[0-9]*", "1.x/sub/name", False),
    ("D2?", "G[!1]*", "D20/G02", True),
    ("D2?", "G[!0]*", "D20/G02", False),
    ("a+b", "*", "a+b/c", True),
    ("a", "*", "a/c/d", False),
])
def test_globs(frame, parent, child, path, hit):
    df = frame([(path,)], "p string")
    assert df.select(F.col("p").rlike(tree.data_dir_regex(parent, child))).first()[0] is hit
