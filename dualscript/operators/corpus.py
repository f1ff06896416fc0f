"""Stage 1: transcript files -> deduplicated train / dev / eval scripts."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from dualscript.functions import text as T
from dualscript.functions.domains import smallest_of
from dualscript.sources.storage import materialise
from dualscript.sources.tree import DEV, EVAL, TRAIN, TXT, SPLIT_FOLDERS, list_tree, quarantine, read_tree, write_script_file

# --- fixed values: vendors whose folder layout is accepted ---
ACCEPTED_VENDORS = ("티맥스소프트", "솔루게이트")
# --- end of fixed values ---

FEW_DOMAINS = 32  # names up to which each is tested on its own
BROADCAST_ROWS = 100_000  # largest known row count that is broadcast by hint
SALTS = 64  # sub-groups per domain when picking held-out folders
LIST_SIZE = 1_000  # target length of one collected folder list


def gate_vendors(scenarios: DataFrame, accepted: Sequence[str] = ACCEPTED_VENDORS) -> DataFrame:
    """Mark scenarios as accepted, or say why not."""
    ok = F.col("vendor").isin(list(accepted))
    return scenarios.withColumn("accepted", F.coalesce(ok, F.lit(False))).withColumn(
        "reason", F.when(~F.col("accepted"), F.concat(F.lit("vendor not supported: "), F.coalesce("vendor", F.lit("")))
        )
    )


def label_files(files: DataFrame, name_contains: str = TXT) -> DataFrame:
    """Text files that hold a label: extension by substring, not blank."""
    return files.where(F.contains(F.col("file_name"), F.lit(name_contains))).where(
        ~T.is_blank(F.col("text"))
    )


def domain_of(path: Column, domains: Sequence[str]) -> Column:
    """The smallest domain name contained in the path, NULL if none is.

    The domains come from a configuration mapping, so this is a projection and
    needs no join.  A few names are tested one by one inside the JVM; many are
    found together by automata (``domains.smallest_of``).
    """
    names = sorted(domains)
    if len(names) > FEW_DOMAINS:
        return smallest_of(path, names)
    return F.get(F.filter(F.lit(names).cast("array<string>"), lambda d: F.contains(path, d)), F.lit(0))


def domain_dirs(files: DataFrame, domains: Sequence[str], path: str = "dir") -> DataFrame:
    """Distinct ``domain, dir`` of the folders that belong to a domain."""
    return (
        files.select(path).distinct()
        .select(domain_of(F.col(path), domains).alias("domain"), path)
        .where("domain IS NOT NULL")
    )


def domain_dir_lists(files: DataFrame, domains: Sequence[str], list_size: int = LIST_SIZE) -> DataFrame:
    """Sorted folder lists per domain.

    A domain with more folders than ``list_size`` is spread over numbered
    lists of about that size, so no task gathers a whole domain.
    """
    dirs = domain_dirs(files, domains)
    sizes = dirs.groupBy("domain").agg(F.ceil(F.count("*") / list_size).alias("lists"))
    slot = F.conv(F.substring(F.md5("dir"), 1, 8), 16, 10).cast("bigint") % F.col("lists")
    # ``sizes`` has one row per configured domain and never grows with the data.
    return (
        dirs.join(F.broadcast(sizes), "domain")
        .groupBy("domain", slot.alias("list_no"))
        .agg(F.sort_array(F.collect_list("dir")).alias("dirs"))
    )


def pick_dev_dirs(files: DataFrame, quota: Mapping[str, int], seed: str = "0", path: str = "dir") -> DataFrame:
    """``domain`` and ``path``: up to ``quota[domain]`` folders per domain in seeded hash order.

    ``files`` may be a listing: only the folder column is read.  Ranking runs
    per domain and salt first; only each salt's best candidates meet in the
    second ranking, so a domain with most of the folders is shared by many
    tasks.  Each ranking stops at the largest quota, which the plan knows.
    """
    wanted = F.create_map(*[F.lit(x) for kv in quota.items() for x in kv])
    order = [F.md5(F.concat(F.lit(seed + "|"), F.col(path))), F.col(path)]
    salt = F.pmod(F.xxhash64(path), F.lit(SALTS))
    most = max(quota.values(), default=0)
    ranked = domain_dirs(files, list(quota), path).withColumn("salt", salt)
    for group in (["domain", "salt"], ["domain"]):
        place = F.row_number().over(Window.partitionBy(*group).orderBy(*order))
        ranked = ranked.withColumn("place", place).where(F.col("place") <= most)
    return ranked.where(F.col("place") <= F.try_element_at(wanted, F.col("domain"))).select("domain", path)


def quota_shortage(dev_dirs: DataFrame, quota: Mapping[str, int]) -> DataFrame:
    """Domains that have fewer folders than asked for."""
    spark = dev_dirs.sparkSession
    asked = spark.createDataFrame(list(quota.items()), "domain string, n_dev int")
    found = dev_dirs.groupBy("domain").agg(F.count("*").alias("n_found"))
    return (
        asked.join(found, "domain", "left")
        .select("domain", F.col("n_dev").cast("bigint").alias("n_dev"), F.coalesce("n_found", F.lit(0)).alias("n_found"))
        .where("n_found < n_dev")
    )


def _dev_lookup(dev_dirs: DataFrame, quota: Mapping[str, int]) -> DataFrame:
    """The held-out folders; broadcast only while the quota proves them few."""
    few = sum(quota.values()) <= BROADCAST_ROWS
    dirs = dev_dirs.select("dir")
    return F.broadcast(dirs) if few else dirs


def dev_files(files: DataFrame, dev_dirs: DataFrame, quota: Mapping[str, int]) -> DataFrame:
    return files.join(_dev_lookup(dev_dirs, quota), "dir", "left_semi")


def train_files(files: DataFrame, dev_dirs: DataFrame, quota: Mapping[str, int]) -> DataFrame:
    return files.join(_dev_lookup(dev_dirs, quota), "dir", "left_anti")


def split_files(files: DataFrame, dev_dirs: DataFrame, quota: Mapping[str, int]) -> DataFrame:
    """Files with a ``split`` column of train or dev, in one pass."""
    held = _dev_lookup(dev_dirs, quota).withColumn("held", F.lit(True))
    return files.join(held, "dir", "left").withColumn(
        "split", F.when(F.col("held"), DEV).otherwise(TRAIN)
    ).drop("held")


def unique_scripts(files: DataFrame, *within: str) -> DataFrame:
    """Distinct texts, separately per ``within`` columns."""
    return files.select(*within, "text").distinct()


def script_counts(files: DataFrame, *within: str) -> DataFrame:
    """Total and distinct texts; 256-bit digests, not texts, are shuffled."""
    digest = F.unhex(F.sha2("text", 256))
    return files.groupBy(*within).agg(
        F.count("*").alias("n_total"), F.count_distinct(digest).alias("n_unique")
    )


# ---------------------------------------------------------------- the whole stage


@dataclass(frozen=True)
class Scenario:
    """One source tree with its own layout and quotas."""

    name: str
    root: str
    vendor: str = ACCEPTED_VENDORS[0]
    parent_glob: str = "*"
    child_glob: str = "**/*"
    quota: Mapping[str, int] = field(default_factory=dict)
    folders: Mapping[bool, str] = field(default_factory=lambda: dict(SPLIT_FOLDERS))


def accepted(spark: SparkSession, scenarios: Sequence[Scenario]) -> tuple[list[Scenario], DataFrame]:
    """Scenarios whose vendor's layout is known, and ``gate_vendors`` of all of them."""
    gate = gate_vendors(spark.createDataFrame([(s.name, s.vendor) for s in scenarios], "scenario string, vendor string"))
    return [s for s in scenarios if s.vendor in ACCEPTED_VENDORS], gate


def scenario_holdout(spark: SparkSession, scenario: Scenario, seed: str = "0") -> DataFrame:
    """``domain, rel``: the training folders held out for dev, decided on the listing alone."""
    files = list_tree(spark, scenario.root, scenario.folders[True], scenario.parent_glob, scenario.child_glob)
    return pick_dev_dirs(files, scenario.quota, seed, "rel")


def scenario_files(spark: SparkSession, scenario: Scenario, split: str, held: Sequence[str] = ()) -> DataFrame:
    """The text files of one split; of train all but the ``held`` folders are opened, of dev only these."""
    chosen = {TRAIN: {"but_dirs": held}, DEV: {"only_dirs": held}, EVAL: {}}[split]
    return read_tree(spark, scenario.root, scenario.parent_glob, scenario.child_glob, folder=scenario.folders[split != EVAL], **chosen)


def first_scripts(files: DataFrame) -> DataFrame:
    """``text, dir, file_name``: each distinct text with the first folder and file that hold it.

    The digest of the text is the key, so no text is compared in a shuffle; the
    one text per key is carried by the aggregate.
    """
    place = F.struct("dir", "file_name")
    kept = files.groupBy(F.sha2("text", 256).alias("_digest")).agg(F.min_by("text", place).alias("text"), F.min(place).alias("_at"))
    return kept.select("text", "_at.*")


def make_scripts(
    spark: SparkSession, scenarios: Sequence[Scenario], out: str, is_train: bool = True, seed: str = "0",
) -> dict[str, DataFrame]:
    """Stage 1 from files: train and dev, or eval, each as one ordered script file ``out/<split>.trn``.

    Returns a report per split: ``n_total`` labelled files and ``n_unique``
    scripts, and under ``rejected`` the files that are not UTF-8 and the
    scenarios of other vendors.  Held-out folders are known by name on the
    driver, at most the sum of the quotas, which must not exceed ``BROADCAST_ROWS``.
    """
    good, gate = accepted(spark, scenarios)
    rejected = [gate.where("not accepted").select(F.col("scenario").alias("path"), "reason")]
    held: dict[str, list[str]] = {}
    for s in good if is_train else ():
        if sum(s.quota.values()) > BROADCAST_ROWS:
            raise ValueError(f"{s.name}: more than {BROADCAST_ROWS} folders to hold out")
        held[s.name] = [r.rel for r in scenario_holdout(spark, s, seed).select("rel").collect()]
    report: dict[str, DataFrame] = {}
    found = []
    for s in good:
        files = read_tree(spark, s.root, s.parent_glob, s.child_glob, folder=s.folders[is_train])
        is_dev = F.col("rel").isin(held[s.name]) if held.get(s.name) else F.lit(False)
        found.append(files.withColumn("split", F.when(is_dev, DEV).otherwise(TRAIN) if is_train else F.lit(EVAL)))
    if found:
        # files are listed and opened once; what follows reads the stored texts
        readable, broken = quarantine(materialise(reduce(DataFrame.unionByName, found), "files"))
        rejected.append(broken)
        for split in (TRAIN, DEV) if is_train else (EVAL,):
            # a split without quota, such as dev of no domains, is an empty file
            labelled = label_files(readable).where(F.col("split") == split)
            write_script_file(first_scripts(labelled), f"{out}/{split}.trn", "dir", "file_name")
            report[split] = script_counts(labelled)
    report["rejected"] = reduce(DataFrame.unionByName, rejected)
    return report
