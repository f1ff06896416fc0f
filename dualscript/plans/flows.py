"""Whole stages from files to files, as queries: trees, CSV folders, metric files.

The files are derived from the driver's tables first and then read as any
other input.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dualscript.functions import arrays as A
from dualscript.operators import corpus, curate, metrics, pairs, vocabulary
from dualscript.plans import queries as Q
from dualscript.plans.fixtures import QUOTA, fixture, table
from dualscript.sources import pair_csv, storage, tree

QUERIES: dict[str, Q.Query] = {}


def query(fn: Q.Query) -> Q.Query:
    QUERIES[fn.__name__] = fn
    return fn


def _fresh(spark: SparkSession, label: str) -> str:
    return f"{storage.shared_dir(spark)}/{label}-{storage.fresh_name()}"


# --- trees ---

FOLDERS = {True: "split=1.Training", False: "split=2.Validation"}
LATER = {"src5.d": 2, "src6.d": 1}  # quotas of the second scenario


def _tree(spark: SparkSession, sf: str) -> str:
    """The labelled files as a tree of folders, one file each under its own name."""
    root = _fresh(spark, "tree")
    parts = F.split("dir", "/")
    folder = F.concat_ws("/", *[F.concat(F.lit(f"{name}="), parts[i]) for i, name in ((2, "split"), (3, "domain"), (4, "g"), (5, "s"))])
    tree.write_files(fixture(spark, sf, "raw_files").select(folder.alias("dir"), "file_name", "text"), root)
    return root


def _scenarios(root: str) -> list[corpus.Scenario]:
    """Two layouts with their own patterns and quotas, and one of a vendor that is not accepted."""
    return [
        corpus.Scenario("early", root, parent_glob="domain=src[0-4].d", child_glob="**/s=*", quota=QUOTA, folders=FOLDERS),
        corpus.Scenario("late", root, vendor=corpus.ACCEPTED_VENDORS[1], parent_glob="domain=src[5-9]*", child_glob="g=G[!1]/s=S[0-5]",
                        quota=LATER, folders=FOLDERS),
        corpus.Scenario("other", root, vendor="한국전자통신연구원", folders=FOLDERS),
    ]


@query
def tree_listing(spark, sf):
    """Files and bytes of text per training folder, without opening a file."""
    first = _scenarios(_tree(spark, sf))[0]
    files = tree.list_tree(spark, first.root, FOLDERS[True], first.parent_glob, first.child_glob)
    size = F.when(F.contains("file_name", F.lit(tree.TXT)), F.col("n_bytes")).otherwise(0)
    return files.groupBy("rel").agg(F.count("*").alias("n_files"), F.sum(size).alias("n_bytes"))


@query
def tree_holdout(spark, sf):
    """Held-out folders of both scenarios, from listings."""
    first, second, _ = _scenarios(_tree(spark, sf))
    return corpus.scenario_holdout(spark, first, Q.SEED).unionByName(corpus.scenario_holdout(spark, second, Q.SEED))


@query
def tree_scripts(spark, sf):
    """Lines of the train, dev and eval script files that stage 1 writes."""
    root, out = _tree(spark, sf), _fresh(spark, "scripts")
    for is_train in (True, False):
        corpus.make_scripts(spark, _scenarios(root), out, is_train, Q.SEED)
    lines = pair_csv.union_all([
        spark.read.text(f"{out}/{split}.trn", lineSep="\n").select(F.lit(split).alias("split"), F.col("value").alias("line"))
        for split in (tree.TRAIN, tree.DEV, tree.EVAL)])
    return lines.groupBy("split", "line").agg(F.count("*").alias("n"))


@query
def tree_report(spark, sf):
    """Total and distinct scripts per split, and what was rejected."""
    root, out = _tree(spark, sf), _fresh(spark, "scripts")
    report = corpus.make_scripts(spark, _scenarios(root), out, True, Q.SEED) | corpus.make_scripts(spark, _scenarios(root), out, False, Q.SEED)
    counts = [report[s].select(F.lit(s).alias("what"), "n_total", "n_unique") for s in (tree.TRAIN, tree.DEV, tree.EVAL)]
    rejected = report["rejected"].select(F.concat_ws(" ", "path", "reason").alias("what"), F.lit(None).cast("bigint").alias("n_total"),
                                         F.lit(None).cast("bigint").alias("n_unique"))
    return pair_csv.union_all([*counts, rejected])


@query
def smallest_names(spark, sf):
    """The smallest of fifty thousand names contained in each path."""
    names = [f"{k}." for k in range(50_000)]
    paths = fixture(spark, sf, "trn_lines").select("line_id", F.substring_index("raw", " :: ", 1).alias("path"))
    return paths.select("line_id", corpus.domain_of(F.col("path"), names).alias("name"))


# --- pair CSV ---


@query
def csv_rejects(spark, sf):
    """Lines of a CSV folder that are no pair, with the reason."""
    path, k = _fresh(spark, "ragged"), F.col("line_id").cast("string")
    line = (F.when(F.col("line_id") % 5 == 0, k).when(F.col("line_id") % 5 == 1, F.concat_ws(",", k, F.lit("a"), F.lit("b")))
            .when(F.col("line_id") % 5 == 2, F.concat(F.lit('"'), k, F.lit(', x",y'))).when(F.col("line_id") % 5 == 3, "")
            .otherwise(F.concat(F.lit('"'), k, F.lit(',x",y,"z"'))))
    fixture(spark, sf, "trn_lines").select(line.alias("line")).write.text(path)
    return pair_csv.read_pairs(spark, path, header=False)[1]


def _cleaned(spark: SparkSession, sf: str) -> tuple[dict[str, DataFrame], str]:
    source, out = _fresh(spark, "pairs"), _fresh(spark, "post")
    pair_csv.write_pairs(fixture(spark, sf, "doc_pair_rows"), source)
    return curate.clean_csv(spark, [source], out), out


@query
def csv_clean(spark, sf):
    """Cleaned pairs as read from the CSV that the stage wrote, and the quarantined ones."""
    report, out = _cleaned(spark, sf)
    kept = pair_csv.read_pairs(spark, out)[0].withColumn("kind", F.lit("kept"))
    return kept.unionByName(report["quarantine"].withColumn("kind", F.lit("quarantine")))


@query
def csv_clean_profile(spark, sf):
    """Lengths before and after cleaning, from one pass over the CSV."""
    return Q._rounded(_cleaned(spark, sf)[0]["profile"], 4)


@query
def csv_clean_sizes(spark, sf):
    return _cleaned(spark, sf)[0]["sizes"]


@query
def split_load(spark, sf):
    """Pairs of every split, loaded from several CSV folders."""
    base = _fresh(spark, "splits")
    split = storage.materialise(pairs.head_split(Q._pairs(spark, sf)), "split")
    parts = {"valid": [split.where("split = 'valid'")], "train": [split.where(f"split = 'train' and pos % 2 = {k}") for k in range(2)]}
    paths = {name: [f"{base}/{name}-{k}" for k in range(len(frames))] for name, frames in parts.items()}
    for name, frames in parts.items():
        for frame, path in zip(frames, paths[name]):
            pair_csv.write_pairs(frame, path)
    return pair_csv.read_splits(spark, paths)


# --- metrics ---


@query
def metrics_file(spark, sf):
    """All metrics, written as a metric file and read back."""
    path = _fresh(spark, "metrics")
    out = metrics.evaluate(Q._pred_ref(spark, sf), Q.ROW)
    pair_csv.write_metrics(out, path)
    return Q._rounded(spark.read.schema(out.schema).json(path))


@query
def rouge_lsum_rows(spark, sf):
    """ROUGE-Lsum of texts of several lines: each turn against its conversation's turn before it."""
    t = table(spark, sf, "conversations").select("conv_id", "turn", "text")
    before = t.select("conv_id", (F.col("turn") + 2).alias("turn"), F.col("text").alias("pred"))
    both = t.withColumnRenamed("text", "ref").join(before, Q.ROW, "left")
    return Q._rounded(metrics.rouge_l_rows(both, Q.ROW))


@query
def logits_eval(spark, sf):
    """Logits to ids by arg-max, ids to words, words to metrics."""
    e = table(spark, sf, "embeddings")
    quarter = (F.size("embedding") / 4).cast("int")

    def ids(vector):
        rows = F.transform(F.sequence(F.lit(0), F.lit(3)), lambda i: F.slice(vector, i * quarter + 1, quarter))
        return F.transform(A.arg_max_rows(rows), lambda i: (i + len(vocabulary.SPECIALS)).cast("int"))

    masked = F.transform(ids(F.col("embedding")), lambda x, i: F.when(i == 3, -100).otherwise(x))
    both = e.select("vec_id", ids(F.transform("embedding", F.abs)).alias("pred_ids"), masked.alias("label_ids"))
    v = vocabulary.build_vocab(Q._stored_pairs(spark, sf), "num_col", "sen_col")
    return Q._rounded(metrics.evaluate(metrics.decode_predictions(both, "vec_id", v), ["vec_id"]))
