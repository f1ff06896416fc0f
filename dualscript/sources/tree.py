"""Transcript trees: ``{root}/{scenario}/{split folder}/{domain}/.../*.txt``."""

from __future__ import annotations

import re
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from dualscript.functions import text as T
from dualscript.sources.storage import fresh_name, materialise

# --- fixed values: file extensions, split names and split folders ---
TXT, WAV, TRN, PCM = ".txt", ".wav", ".trn", ".pcm"
TRAIN, EVAL, DEV = "train", "eval", "dev"
SPLIT_FOLDERS = {True: "1.Training", False: "2.Validation"}
# --- end of fixed values ---

SCANS_A_TASK = 32  # a task reads so many of Spark's file partitions, about 32 small files each
FILES_A_TASK, BYTES_A_TASK, FOLDERS_A_TASK = 1_024, 128 << 20, 1_024  # of the files and folders that tasks open themselves
COMPRESSED = r"(?i)\.(deflate|gz|gzip|bz2|lz4|lzo|snappy|zst|br|passthrough)\z"  # names that Spark's reader may unpack


def _segment_regex(glob: str) -> str:
    """One path segment of a glob as a regexp."""
    out, i = "", 0
    while i < len(glob):
        char = glob[i]
        close = glob.find("]", i + 2) if char == "[" else -1
        if char == "*":
            out += "[^/]*"
        elif char == "?":
            out += "[^/]"
        elif close > 0:
            body = glob[i + 1 : close].replace("\\", "\\\\").replace("[", "\\[")
            out += "[" + ("^" + body[1:] if body[0] == "!" else body) + "]"
            i = close
        else:
            out += re.escape(char)
        i += 1
    return out


def glob_regex(glob: str) -> str:
    """A relative path glob as a regexp; ``**`` stands for any number of folders."""
    parts = glob.strip("/").split("/")
    out = ""
    for i, part in enumerate(parts):
        last = i == len(parts) - 1
        if part == "**":
            out += "(?:[^/]+(?:/[^/]+)*)?" if last else "(?:[^/]+/)*"
        else:
            out += _segment_regex(part) + ("" if last else "/")
    return out


def data_dir_regex(parent_glob: str, child_glob: str) -> str:
    """Folders matched by ``child_glob`` below any folder matched by ``parent_glob``."""
    return rf"^(?:[^/]+/)*{glob_regex(parent_glob)}/{glob_regex(child_glob)}\z"


def _plain_path(column: Column) -> Column:
    """A file's path without scheme and escapes."""
    path = F.regexp_replace(column, r"^[A-Za-z0-9]+:/+", "/")
    return F.url_decode(F.replace(path, F.lit("+"), F.lit("%2B")))


def _base(spark: SparkSession, root: str) -> str:
    """``root`` as it begins the plain paths below it."""
    base = spark._jvm.org.apache.hadoop.fs.Path(root)
    files = base.getFileSystem(spark._jsc.hadoopConfiguration())
    return files.makeQualified(base).toUri().getPath().rstrip("/")


def _located(path: Column, base: str) -> dict[str, Column]:
    directory = T.path_dir(path)
    return {"path": path, "dir": directory, "rel": F.substr(directory, F.lit(len(base) + 2)), "file_name": T.path_name(path)}


def _split_root(root: str, folder: str | None) -> str:
    return f"{root.rstrip('/')}/{folder}" if folder else root


def _in_fewer_tasks(scan: DataFrame) -> DataFrame:
    """A plain scan of very many small files in tasks that are worth their start.

    Spark counts a file as 4 MB at least, so a task would read 32 files.
    """
    parts = scan.rdd.getNumPartitions()
    enough = max(4 * scan.sparkSession.sparkContext.defaultParallelism, parts // SCANS_A_TASK)
    return scan.coalesce(enough) if parts > enough else scan


def write_files(files: DataFrame, root: str) -> None:
    """One file per row of ``dir, file_name, text``: ``root/dir/file_name`` holds the text and a newline.

    Tasks write their rows into place through Arrow's file systems; a file gets
    its name when it is whole, so a repeated task changes nothing.  Spark's own
    writers start a process per file on a local file system, to set its mode.
    """
    path = files.sparkSession._jvm.org.apache.hadoop.fs.Path(root)
    top = path.getFileSystem(files.sparkSession._jsc.hadoopConfiguration()).makeQualified(path).toString()
    top = re.sub("^file:/+", "file:///", top)

    def write(batches):
        import uuid

        import pyarrow as pa
        from pyarrow import fs

        store, base = fs.FileSystem.from_uri(top)
        made = set()
        for batch in batches:
            for folder, name, text in zip(*[c.to_pylist() for c in batch.columns]):
                at = f"{base}/{folder}"
                if at not in made:
                    store.create_dir(at)
                    made.add(at)
                part = f"{at}/.{name}-{uuid.uuid4().hex}"  # names with a dot in front are not read
                with store.open_output_stream(part) as out:
                    out.write((text or b"") + b"\n")
                store.move(part, f"{at}/{name}")
            yield pa.record_batch({"n": pa.array([batch.num_rows], pa.int64())})

    rows = files.select("dir", "file_name", F.col("text").cast("binary").alias("text"))
    rows.mapInArrow(write, "n bigint").agg(F.sum("n")).first()


def _folder(spark: SparkSession, root: str) -> tuple[str, str] | None:
    """URI and plain path of a folder that Arrow's file systems open by its path (local, HDFS); else Spark's scans do the work."""
    import pyarrow as pa
    from pyarrow import fs

    path = spark._jvm.org.apache.hadoop.fs.Path(root)
    uri = path.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(path).toUri().toASCIIString()
    uri = re.sub("^file:/+", "file:///", uri)
    try:
        store, at = fs.FileSystem.from_uri(uri)
        found = at.startswith("/") and store.get_file_info(at).type == fs.FileType.Directory
    except (pa.ArrowException, OSError):
        return None
    return (uri, at.rstrip("/")) if found else None


def _files(spark: SparkSession, uri: str, base: str) -> DataFrame:
    """``path, n_bytes`` of the files below a folder, stored: those that Spark's scans read, not hidden and not empty.

    Tasks list the folders, one level after the other, so the driver holds no
    entry of a file or folder.  Spark's own listing ends in the driver.
    """
    def children(batches):
        import pyarrow as pa
        from pyarrow import fs

        store, _ = fs.FileSystem.from_uri(uri)
        for batch in batches:
            for folder in batch.column(0).to_pylist():
                found = []
                for x in store.get_file_info(fs.FileSelector(folder)):
                    name, is_dir = x.base_name, x.type == fs.FileType.Directory
                    hidden = name.startswith(".") or name.startswith("_") and "=" not in name or name.endswith("._COPYING_")
                    if is_dir and (not hidden or name.startswith(("_metadata", "_common_metadata"))):
                        found.append((x.path, True, 0))
                    elif x.type == fs.FileType.File and not hidden and x.size:
                        found.append((x.path, False, x.size))
                for i in range(0, len(found), 10_000):
                    columns = zip(*found[i:i + 10_000])
                    yield pa.record_batch([pa.array(c, t) for c, t in zip(columns, (pa.string(), pa.bool_(), pa.int64()))], ["path", "is_dir", "n_bytes"])

    enough = 4 * spark.sparkContext.defaultParallelism
    folders, levels = spark.range(1, numPartitions=1).select(F.lit(base).alias("path")), []
    while True:
        level = materialise(folders.mapInArrow(children, "path string, is_dir boolean, n_bytes bigint"), "tree-level")
        levels.append(level.where("not is_dir").select("path", "n_bytes"))
        folders = level.where("is_dir").select("path")
        n = folders.count()
        if not n:
            return materialise(reduce(DataFrame.unionByName, levels), "tree-listing")
        folders = folders.repartition(min(n, max(enough, n // FOLDERS_A_TASK)))


def _contents(files: DataFrame, uri: str) -> DataFrame:
    """``path, value``: the bytes of the files ``path, n_bytes``, read by tasks of about the same number of files or bytes."""
    def opened(batches):
        import pyarrow as pa
        from pyarrow import fs

        store, _ = fs.FileSystem.from_uri(uri)
        paths, values, size = [], [], 0
        for batch in batches:
            for path in batch.column(0).to_pylist():
                with store.open_input_stream(path, compression=None) as file:
                    value = file.read()
                paths.append(path)
                values.append(value)
                size += len(value)
                if size > 4 << 20 or len(paths) == 1_000:
                    yield pa.record_batch([pa.array(paths, pa.string()), pa.array(values, pa.binary())], ["path", "value"])
                    paths, values, size = [], [], 0
        if paths:
            yield pa.record_batch([pa.array(paths, pa.string()), pa.array(values, pa.binary())], ["path", "value"])

    n, size = files.agg(F.count("*"), F.coalesce(F.sum("n_bytes"), F.lit(0))).first()
    enough = 4 * files.sparkSession.sparkContext.defaultParallelism
    tasks = max(1, min(n, max(enough, n // FILES_A_TASK, size // BYTES_A_TASK)))
    return files.select("path").repartition(tasks, "path").mapInArrow(opened, "path string, value binary")


def list_tree(
    spark: SparkSession, root: str, folder: str | None = None, parent_glob: str = "*", child_glob: str = "**/*",
) -> DataFrame:
    """``path, dir, rel, file_name, n_bytes`` of the files below ``root/folder``; no file is opened.

    Tasks list the folders.  Globs start at ``root/folder``, and
    ``rel`` is the folder relative to it.  Files of any name are listed, so a
    folder without a label is a folder too; each path appears once however many
    globs reach it, and files are never mistaken for folders.
    """
    top = _split_root(root, folder)
    at = _folder(spark, top)
    if at:
        found = _files(spark, *at).select(*[c.alias(n) for n, c in _located(F.col("path"), at[1]).items()], "n_bytes")
        return found.where(F.col("rel").rlike(data_dir_regex(parent_glob, child_glob)))
    base = _base(spark, top)
    # without the column of contents this source only asks the file system
    raw = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(top)
    found = raw.select(*[c.alias(n) for n, c in _located(_plain_path(F.col("path")), base).items()], F.col("length").alias("n_bytes"))
    return _in_fewer_tasks(found.where(F.col("rel").rlike(data_dir_regex(parent_glob, child_glob))))


def read_tree(
    spark: SparkSession, root: str, parent_glob: str = "*", child_glob: str = "**/*", name_contains: str = TXT,
    folder: str | None = None, only_dirs: Sequence[str] | None = None, but_dirs: Sequence[str] | None = None,
) -> DataFrame:
    """Whole text files of a tree: ``path, dir, rel, file_name, text, valid``.

    Only what lies below ``root/folder`` is listed, by tasks, and globs start there.
    ``name_contains`` is a substring test on the file name.  Each path appears
    once however many globs reach its folder.  ``valid`` is false for files
    that are not UTF-8; ``quarantine`` separates them.  Of ``only_dirs`` or all
    ``but_dirs``, lists of relative folders, other files are left out before
    any is opened.
    """
    top = _split_root(root, folder)

    def chosen(files: DataFrame, at: dict[str, Column]) -> DataFrame:
        # tests on the file's own path alone choose files, not rows
        wanted = files.where(at["rel"].rlike(data_dir_regex(parent_glob, child_glob)))
        if only_dirs is not None:
            wanted = wanted.where(at["rel"].isin(list(only_dirs)) if only_dirs else F.lit(False))
        if but_dirs:
            wanted = wanted.where(~at["rel"].isin(list(but_dirs)))
        return wanted

    folder_at, texts = _folder(spark, top), None
    if folder_at:
        at = _located(F.col("path"), folder_at[1])
        files = chosen(_files(spark, *folder_at).where(F.contains(at["file_name"], F.lit(name_contains))), at)
        if files.where(F.col("path").rlike(COMPRESSED)).isEmpty():
            texts = _contents(files, folder_at[0]).withColumn("value", F.col("value").cast("string"))
    if texts is None:
        raw = (
            spark.read.option("recursiveFileLookup", "true")
            .option("pathGlobFilter", f"*{name_contains}*")
            .text(top, wholetext=True)
        )
        at = _located(_plain_path(F.col("_metadata.file_path")), _base(spark, top))
        texts = _in_fewer_tasks(chosen(raw, at))
    return texts.select(
        *[c.alias(n) for n, c in at.items()],
        # Text mode reading turns every line ending into a newline.
        F.regexp_replace("value", "\r\n?", "\n").alias("text"),
        F.is_valid_utf8("value").alias("valid"),
    )


def quarantine(files: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(readable files, undecodable files with a reason)."""
    good = files.where("valid").drop("valid")
    bad = files.where("NOT valid").select("path", F.lit("not utf-8").alias("reason"))
    return good, bad


def select_split(files: DataFrame, is_train: bool, folders: dict[bool, str] = SPLIT_FOLDERS):
    """Files under the training or the validation folder."""
    return files.where(F.contains(F.col("dir"), F.lit(f"/{folders[is_train]}/")))


def write_scripts(scripts: DataFrame, path: str) -> None:
    """One script per line, replacing what was there."""
    scripts.select("text").write.mode("overwrite").text(path)


def write_script_file(scripts: DataFrame, path: str, *order: str) -> None:
    """All scripts in one text file, ordered, joined by newlines, without a final one.

    Tasks write sorted range partitions; the parts are then copied one after
    the other into a file beside the target and renamed onto it, so a reader
    sees the old file or the new one.  One file has one writer by nature: the
    copy streams through the driver's JVM and holds nothing.  ``write_scripts``
    is for outputs that need not be one file.
    """
    spark = scripts.sparkSession
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    Path, io = jvm.org.apache.hadoop.fs.Path, jvm.org.apache.commons.io.IOUtils
    target = Path(path)
    files = target.getFileSystem(conf)
    parts = Path(f"{path}.parts-{fresh_name()}")
    whole = Path(f"{path}.whole-{fresh_name()}")
    ranges = int(spark.conf.get("spark.sql.shuffle.partitions"))
    scripts.repartitionByRange(ranges, *order).sortWithinPartitions(*order).select("text").write.text(parts.toString())
    try:
        # part files are named by their partition
        found = sorted((f.getPath().getName(), f.getLen()) for f in files.listStatus(parts) if f.getPath().getName().startswith("part-"))
        found = [(name, size) for name, size in found if size]
        out = files.create(whole, True)
        try:
            for k, (name, size) in enumerate(found):
                source = files.open(Path(parts, name))
                try:
                    io.copyLarge(source, out, 0, size - (k == len(found) - 1))
                finally:
                    source.close()
        finally:
            out.close()
        mode = jvm.org.apache.hadoop.fs.FileContext.getFileContext(target.toUri(), conf)
        overwrite = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 1)
        overwrite[0] = jvm.org.apache.hadoop.fs.Options.Rename.OVERWRITE
        qualified = files.makeQualified
        mode.rename(qualified(whole), qualified(target), overwrite)
    finally:
        files.delete(parts, True)
        files.delete(whole, False)
