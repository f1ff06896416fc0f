"""One runnable query per operator over the driver's tables.

Arrays are shown as space-joined text and measures are rounded, so that any
SQL engine can confirm the values.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from dualscript.functions import arrays as A
from dualscript.functions import text as T
from dualscript.functions.tokenize13a import tokens_13a
from dualscript.operators import corpus, curate, examples, lexicon, metrics, pairs, vocabulary
from dualscript.plans.fixtures import QUOTA, fixture, table
from dualscript.sources import pair_csv, storage, tree, trn
from dualscript.streaming import ingest

def _documents(spark: SparkSession, sf: str) -> DataFrame:
    return storage.spread(table(spark, sf, "documents"))


Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

SEED = "7"


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


def _ids(column: str) -> Column:
    return F.array_join(F.col(column).cast("array<string>"), " ")


def _rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    """Round every DOUBLE column."""
    return df.select(
        *[F.round(c, digits).alias(c) if t == "double" else F.col(c) for c, t in df.dtypes]
    )


def _lines(spark: SparkSession, sf: str) -> DataFrame:
    return fixture(spark, sf, "trn_lines").withColumnRenamed("line_id", "pos")


def _pairs(spark: SparkSession, sf: str) -> DataFrame:
    return pairs.sentence_pairs(_lines(spark, sf))


def _stored_pairs(spark: SparkSession, sf: str) -> DataFrame:
    """Pairs that several steps of a query read."""
    return storage.materialise(_pairs(spark, sf), "pairs")


def _files(spark: SparkSession, sf: str, is_train: bool = True) -> DataFrame:
    return corpus.label_files(tree.select_split(fixture(spark, sf, "raw_files"), is_train))


def _listing(spark: SparkSession, sf: str, is_train: bool = True) -> DataFrame:
    """The files of a split as a listing: folders and names, no text."""
    return tree.select_split(fixture(spark, sf, "raw_files").select("dir", "file_name"), is_train)


# --- string functions ---


@query
def trn_sentences(spark, sf):
    """The delimited sentence of each transcript line."""
    return pairs.sentences(_lines(spark, sf)).select("pos", "sentence")


@query
def bracket_spelling(spark, sf):
    s = pairs.sentences(_lines(spark, sf))
    return s.select("pos", T.bracket_text(F.col("sentence"), "spelling").alias("kept"))


@query
def bracket_phonetic(spark, sf):
    s = pairs.sentences(_lines(spark, sf))
    return s.select("pos", T.bracket_text(F.col("sentence"), "phonetic").alias("kept"))


@query
def special_filter_spelling(spark, sf):
    s = pairs.sentences(_lines(spark, sf))
    return s.select("pos", T.clean_symbols(F.col("sentence"), "spelling").alias("cleaned"))


@query
def special_filter_phonetic(spark, sf):
    """With a reading for '%', and NULL without one."""
    s, c = pairs.sentences(_lines(spark, sf)), F.col("sentence")
    return s.select(
        "pos",
        T.clean_symbols(c, "phonetic").alias("strict"),
        T.clean_symbols(c, "phonetic", " 퍼센트").alias("read"),
    )


@query
def special_filter_docs(spark, sf):
    d = _documents(spark, sf)
    return d.select("doc_id", T.clean_symbols(F.col("text"), "spelling").alias("cleaned"))


@query
def sentence_filter_spelling(spark, sf):
    s = pairs.sentences(_lines(spark, sf))
    return s.select("pos", T.transcript_text(F.col("sentence"), "spelling").alias("cleaned"))


@query
def bracket_pairs(spark, sf):
    """Brackets of each line in pairs."""
    s = pairs.sentences(_lines(spark, sf)).select(
        "pos", F.posexplode(T.stride_pairs(T.bracket_list(F.col("sentence")))).alias("i", "p")
    )
    return s.select("pos", F.col("i").cast("bigint").alias("i"), "p.first", "p.second")


@query
def reading_fold(spark, sf):
    s, c = pairs.sentences(_lines(spark, sf)), F.col("sentence")
    return s.select("pos", T.fold_readings(c, T.bracket_list(c)).alias("folded"))


@query
def whitespace_tokens(spark, sf):
    d = _documents(spark, sf)
    words = T.tokens(F.col("text"))
    return d.select(
        "doc_id", F.size(words).cast("bigint").alias("n_tokens"),
        F.md5(F.array_join(words, "|")).alias("digest"),
    )


@query
def text_sizes(spark, sf):
    """Code points, UTF-8 bytes, last character and its script."""
    c = F.col("sen_col")
    return fixture(spark, sf, "pair_rows").select(
        "pair_id",
        F.length(c).cast("bigint").alias("n_chars"),
        F.octet_length(c).cast("bigint").alias("n_bytes"),
        F.hex(T.utf8(c)).alias("bytes_hex"),
        T.last_char(c).alias("last_char"),
        T.is_hangul(T.last_char(c)).alias("last_hangul"),
    )


@query
def path_parts(spark, sf):
    f = fixture(spark, sf, "raw_files").withColumn("path", T.join_path(F.col("dir"), F.col("file_name")))
    return f.select("doc_id", T.path_dir(F.col("path")).alias("dir"), T.path_name(F.col("path")).alias("file_name"))


# --- stage 1: files -> scripts ---


@query
def vendor_gate(spark, sf):
    return corpus.gate_vendors(fixture(spark, sf, "scenarios"))


@query
def tree_dirs(spark, sf):
    """Distinct folders matched by a pair of globs below a root."""
    below = F.substring("dir", len("/raw/") + 1, 2**30)
    hit = below.rlike(tree.data_dir_regex("src[0-4]*", "**/S[!0-2]"))
    return fixture(spark, sf, "raw_files").select("dir").where(hit).distinct()


@query
def raw_nonblank(spark, sf):
    """Text files of the training folder that hold a label."""
    return _files(spark, sf).select("doc_id", "dir", "file_name")


@query
def script_dedup(spark, sf):
    return corpus.unique_scripts(_files(spark, sf))


@query
def eval_scripts(spark, sf):
    return corpus.unique_scripts(_files(spark, sf, False))


@query
def script_counts(spark, sf):
    files = corpus.label_files(fixture(spark, sf, "raw_files"))
    part = F.element_at(F.split("dir", "/"), 3)
    return corpus.script_counts(files.withColumn("folder", part), "folder")


@query
def domain_paths(spark, sf):
    """Files of configured domains, the smallest domain name winning."""
    f = _files(spark, sf).withColumn("domain", corpus.domain_of(F.col("dir"), list(QUOTA)))
    return f.where("domain IS NOT NULL").select("doc_id", "dir", "domain")


@query
def domain_dir_lists(spark, sf):
    lists = corpus.domain_dir_lists(_listing(spark, sf), list(QUOTA))
    return lists.select("domain", "list_no", F.array_join("dirs", " ").alias("dirs"))


@query
def domain_dir_lists_small(spark, sf):
    """Lists small enough to split the domains here."""
    lists = corpus.domain_dir_lists(_listing(spark, sf), list(QUOTA), list_size=4)
    return lists.select("domain", "list_no", F.array_join("dirs", " ").alias("dirs"))


@query
def dev_holdout(spark, sf):
    return corpus.pick_dev_dirs(_listing(spark, sf), QUOTA, SEED)


@query
def quota_shortage(spark, sf):
    return corpus.quota_shortage(corpus.pick_dev_dirs(_listing(spark, sf), QUOTA, SEED), QUOTA)


@query
def train_scripts(spark, sf):
    files = _files(spark, sf)
    held = corpus.pick_dev_dirs(_listing(spark, sf), QUOTA, SEED)
    return corpus.unique_scripts(corpus.train_files(files, held, QUOTA))


@query
def dev_scripts(spark, sf):
    files = _files(spark, sf)
    held = corpus.pick_dev_dirs(_listing(spark, sf), QUOTA, SEED)
    return corpus.unique_scripts(corpus.dev_files(files, held, QUOTA))


@query
def split_script_counts(spark, sf):
    """Total and distinct scripts of train and dev in one pass."""
    files = _files(spark, sf)
    held = corpus.pick_dev_dirs(_listing(spark, sf), QUOTA, SEED)
    return corpus.script_counts(corpus.split_files(files, held, QUOTA), "split")


# --- stage 2: lines -> pairs ---


@query
def stage2_valid(spark, sf):
    return pairs.valid_pairs(_lines(spark, sf)).select("pos", "num_col", "sen_col")


@query
def stage2_outcomes(spark, sf):
    return pairs.line_outcomes(_lines(spark, sf)).select("pos", "reason")


@query
def sentence_pairs(spark, sf):
    return _pairs(spark, sf)


@query
def pair_split(spark, sf):
    return pairs.head_split(_pairs(spark, sf))


@query
def pair_hash_split(spark, sf):
    return pairs.hash_split(_pairs(spark, sf), seed=SEED)


@query
def split_sizes(spark, sf):
    return pairs.split_sizes(pairs.head_split(_pairs(spark, sf)))


@query
def pair_csv_round_trip(spark, sf):
    """Pairs written as CSV and read back."""
    path = f"{storage.shared_dir(spark)}/csv-{storage.fresh_name()}"
    pair_csv.write_pairs(_pairs(spark, sf), path)
    return pair_csv.read_pairs(spark, path)[0]


def _trn_folder(spark: SparkSession, sf: str) -> str:
    """The transcript lines as text files in script folders.

    File names follow ``line_id`` within a folder.
    """
    path = f"{storage.shared_dir(spark)}/trn-{storage.fresh_name()}"
    lines = fixture(spark, sf, "trn_lines")
    (
        lines.withColumn("folder", F.substring_index("file", "/", 1))
        .repartitionByRange("line_id").sortWithinPartitions("folder", "line_id")
        .select("folder", "raw").write.partitionBy("folder").text(path)
    )
    return path


@query
def trn_file_pairs(spark, sf):
    """Pairs scanned from ``.trn`` files, in file order."""
    lines = trn.read_trn(spark, _trn_folder(spark, sf), "*_scripts")
    return pairs.sentence_pairs(lines).select("num_col", "sen_col")


@query
def trn_file_split(spark, sf):
    """Head split of pairs in file order."""
    lines = trn.read_trn(spark, _trn_folder(spark, sf), "*_scripts")
    return pairs.head_split(pairs.sentence_pairs(lines)).select("num_col", "sen_col", "split")


# --- stage 3: curation ---


@query
def pair_native_keep(spark, sf):
    """Pairs decided without a similarity ratio."""
    return curate.native_verdicts(fixture(spark, sf, "pair_rows")).where("verdict IS NOT NULL")


@query
def pair_filter(spark, sf):
    return curate.filter_pairs(fixture(spark, sf, "pair_rows"))


SIDES = {"sen": "sen_col", "num": "num_col"}


@query
def text_sizes_docs(spark, sf):
    """Sizes of both sides of pairs from whole documents."""
    num, sen = F.col("num_col"), F.col("sen_col")
    return fixture(spark, sf, "doc_pair_rows").select(
        "pair_id",
        F.length(num).cast("bigint").alias("num_chars"),
        F.octet_length(num).cast("bigint").alias("num_bytes"),
        F.length(sen).cast("bigint").alias("n_chars"),
        F.octet_length(sen).cast("bigint").alias("n_bytes"),
        F.hex(T.utf8(sen)).alias("bytes_hex"),
        T.last_char(sen).alias("last_char"),
        T.is_hangul(T.last_char(sen)).alias("last_hangul"),
    )


@query
def length_eda_before_docs(spark, sf):
    return _rounded(curate.length_profile(fixture(spark, sf, "doc_pair_rows"), SIDES), 4)


@query
def length_eda_after_docs(spark, sf):
    return _rounded(curate.length_profile(curate.filter_pairs(fixture(spark, sf, "doc_pair_rows")), SIDES), 4)


@query
def length_eda_before(spark, sf):
    return _rounded(curate.length_profile(fixture(spark, sf, "pair_rows"), SIDES), 4)


@query
def length_eda_after(spark, sf):
    return _rounded(curate.length_profile(curate.filter_pairs(fixture(spark, sf, "pair_rows")), SIDES), 4)


@query
def doc_length_eda(spark, sf):
    return _rounded(curate.length_profile(_documents(spark, sf), {"text": "text"}, "lang"), 3)


# --- stage 4: examples ---


@query
def examples_ntt(spark, sf):
    return examples.directed_examples(_pairs(spark, sf), examples.NUM_TO_TEXT)


@query
def examples_ttn(spark, sf):
    return examples.directed_examples(_pairs(spark, sf), examples.TEXT_TO_NUM)


@query
def examples_prompt(spark, sf):
    return examples.prompt_examples(_pairs(spark, sf))


@query
def examples_causal(spark, sf):
    return examples.causal_examples(_pairs(spark, sf), examples.TEXT_TO_NUM)


@query
def mapped_examples(spark, sf):
    """A user function over batches that drops the source columns: Unicode's composed form, which Spark lacks."""

    def composed(batch):
        out = {c: [unicodedata.normalize("NFC", x) for x in batch[s]] for c, s in (("input", "num_col"), ("label", "sen_col"))}
        return batch[["pos"]].assign(**out)

    return examples.map_batches(_pairs(spark, sf), composed, "pos bigint, input string, label string")


@query
def csv_union(spark, sf):
    """Pairs of two sources stacked by column name."""
    both = pair_csv.union_all([fixture(spark, sf, "pair_rows"), _pairs(spark, sf)])
    return both.fillna(-1, ["pair_id", "pos"])


@query
def csv_union_docs(spark, sf):
    """Pairs of whole documents and of lines, stacked by column name."""
    both = pair_csv.union_all([fixture(spark, sf, "doc_pair_rows"), _pairs(spark, sf)])
    return both.fillna(-1, ["pair_id", "pos"])


@query
def vocabulary_ids(spark, sf):
    return vocabulary.build_vocab(_pairs(spark, sf), "num_col", "sen_col")


@query
def vocabulary_docs(spark, sf):
    return vocabulary.build_vocab(_documents(spark, sf), "text")


@query
def encode_ids(spark, sf):
    p = _stored_pairs(spark, sf)
    v = vocabulary.build_vocab(p, "num_col", "sen_col")
    e = examples.encoded_examples(examples.directed_examples(p, examples.NUM_TO_TEXT), "pos", v)
    return e.select(
        "pos", _ids("input_ids").alias("input_ids"), _ids("labels").alias("labels"),
        F.col("length").cast("bigint").alias("length"),
    )


@query
def encode_prompts(spark, sf):
    """Whole prompt examples over a vocabulary without the prompt."""
    return _prompts(spark, sf, None)


@query
def encode_prompts_cut(spark, sf):
    """The same with a limit of a few ids as the feature under test."""
    return _prompts(spark, sf, 3)


def _prompts(spark: SparkSession, sf: str, max_length: int | None) -> DataFrame:
    p = _stored_pairs(spark, sf)
    v = vocabulary.build_vocab(p, "num_col", "sen_col")
    e = examples.encoded_prompts(examples.prompt_examples(p), "pos", v, max_length)
    return e.select("pos", _ids("input_ids").alias("input_ids"), _ids("labels").alias("labels"))


@query
def decode_ids(spark, sf):
    """Texts that went through their ids, reserved ids skipped."""
    p = _stored_pairs(spark, sf)
    v = vocabulary.build_vocab(p, "sen_col")
    return vocabulary.decode(vocabulary.encode(p, "pos", "sen_col", v, add_eos=True, closed=True), "pos", "ids", v)


@query
def encode_docs(spark, sf):
    d = _documents(spark, sf)
    v = vocabulary.build_vocab(d, "text")
    e = vocabulary.encode(d, "doc_id", "text", v, closed=True)
    return e.select("doc_id", F.md5(_ids("ids")).alias("digest"), F.size("ids").cast("bigint").alias("n_ids"))


@query
def length_buckets(spark, sf):
    b = examples.length_buckets(_documents(spark, sf), "text", 10)
    return b.select("doc_id", F.col("length").cast("bigint").alias("length"), F.col("bucket").cast("bigint").alias("bucket"))


@query
def examples_causal_ids(spark, sf):
    """Both sides as one sequence of ids, reserved ids between them."""
    p = _stored_pairs(spark, sf)
    v = vocabulary.build_vocab(p, "num_col", "sen_col")
    e = examples.encoded_causal(p, "pos", examples.TEXT_TO_NUM, v, closed=True)
    return e.select("pos", _ids("input_ids").alias("input_ids"), _ids("labels").alias("labels"), F.col("length").cast("bigint").alias("length"))


@query
def token_batches(spark, sf):
    """Documents in batches of a padded token budget."""
    b = examples.token_budget_batches(_documents(spark, sf), "text", "doc_id", 20_000)
    return b.select("doc_id", F.col("length").cast("bigint").alias("length"), "batch", "place")


@query
def token_batch_padding(spark, sf):
    return _rounded(examples.padding_report(examples.token_budget_batches(_documents(spark, sf), "text", "doc_id", 20_000)))


@query
def materialised_examples(spark, sf):
    """Examples built from a table, which then grows: the second call builds anew, the third reads."""
    base = f"{storage.shared_dir(spark)}/examples-{storage.fresh_name()}"
    source = f"{base}/pairs"
    p, built = _stored_pairs(spark, sf), []

    def build() -> DataFrame:
        built.append(1)
        return examples.directed_examples(spark.read.parquet(source), examples.NUM_TO_TEXT)

    for part in (F.col("pos") % 2 == 0, F.col("pos") % 2 == 1, None):
        if part is not None:
            p.where(part).write.mode("append").parquet(source)
        out = storage.materialise_or_reuse(spark, f"{base}/examples", build, [source], {"direction": examples.NUM_TO_TEXT})
    if len(built) != 2:
        raise RuntimeError(f"built {len(built)} times, not twice")
    return out


# --- stage 5: metrics ---


def _label_ids(spark, sf) -> DataFrame:
    """Id arrays made from the vectors, every fourth position masked."""
    v = F.transform(
        "embedding",
        lambda x, i: F.when(i % 4 == 3, F.lit(-100)).otherwise(F.floor(F.abs(x.cast("double")) * 1000).cast("int")),
    )
    return table(spark, sf, "embeddings").select("vec_id", v.alias("ids"))


@query
def masked_ids(spark, sf):
    ids = _label_ids(spark, sf).withColumn("ids", A.fill_mask(F.col("ids"), vocabulary.PAD))
    return ids.select("vec_id", _ids("ids").alias("ids"))


@query
def argmax_ids(spark, sf):
    """One vector as the logits of one position."""
    e = table(spark, sf, "embeddings")
    return e.select("vec_id", A.arg_max(F.col("embedding")).cast("bigint").alias("best"))


@query
def argmax_rows(spark, sf):
    """One vector as four positions over a quarter of its length each."""
    e = table(spark, sf, "embeddings")
    quarter = (F.size("embedding") / 4).cast("int")
    # the last position takes what four equal parts leave over
    size = lambda i: F.when(i < 3, quarter).otherwise(F.size("embedding") - 3 * quarter)
    logits = F.transform(
        F.sequence(F.lit(0), F.lit(3)), lambda i: F.slice("embedding", i * quarter + 1, size(i))
    )
    best = e.select("vec_id", A.arg_max_rows(logits).alias("best"))
    return best.select("vec_id", _ids("best").alias("best"))


@query
def array_edits(spark, sf):
    """Append, drop last and truncate on id arrays."""
    ids = F.col("ids")
    e = _label_ids(spark, sf).select(
        "vec_id", A.append_id(A.truncate(ids, 5), vocabulary.EOS).alias("ended"),
        A.drop_last(A.truncate(ids, 3)).alias("shorter"), F.size(ids).cast("bigint").alias("n_ids"),
    )
    return e.select("vec_id", _ids("ended").alias("ended"), _ids("shorter").alias("shorter"), "n_ids")


def _pred_ref(spark, sf) -> DataFrame:
    return fixture(spark, sf, "pred_ref")


ROW = ["conv_id", "turn"]


@query
def tokens_13a_refs(spark, sf):
    return _pred_ref(spark, sf).select(*ROW, F.array_join(tokens_13a(F.col("ref")), " ").alias("tokens"))


@query
def corpus_bleu(spark, sf):
    return _rounded(metrics.corpus_bleu(_pred_ref(spark, sf), ROW))


@query
def rouge_n(spark, sf):
    return _rounded(metrics.rouge_n(_pred_ref(spark, sf), ROW))


@query
def rouge_n_rows(spark, sf):
    return _rounded(metrics.rouge_n_rows(_pred_ref(spark, sf), ROW))


@query
def rouge_l_rows(spark, sf):
    return _rounded(metrics.rouge_l_rows(_pred_ref(spark, sf), ROW).drop("rougeLsum"))


@query
def evaluate_all(spark, sf):
    return _rounded(metrics.evaluate(_pred_ref(spark, sf), ROW))


@query
def decoded_bleu(spark, sf):
    """BLEU of predictions given as ids, labels padded with the mask."""
    p = _pred_ref(spark, sf).withColumn("row_id", F.col("conv_id") * 1000 + F.col("turn"))
    v = vocabulary.build_vocab(p, "pred", "ref")
    pad = F.array(F.lit(-100), F.lit(-100))
    both = vocabulary.encode_texts(p, "row_id", {"pred_ids": "pred", "label_ids": "ref"}, v, closed=True)
    both = both.withColumns(
        {c: F.concat(vocabulary.end_ids(F.col(c)), pad) for c in ("pred_ids", "label_ids")}
    )
    return _rounded(metrics.corpus_bleu(metrics.decode_predictions(both, "row_id", v), ["row_id"]))


# --- lexicon ---


@query
def dual_readings(spark, sf):
    r = lexicon.readings(_lines(spark, sf))
    return r.groupBy("num", "reading", "next_token").agg(F.count("*").alias("n"))


@query
def reading_lexicon(spark, sf):
    return lexicon.reading_lexicon(_lines(spark, sf))


@query
def spelling_lexicon(spark, sf):
    """The other direction: reading -> numerals."""
    return lexicon.reading_lexicon(_lines(spark, sf), examples.TEXT_TO_NUM)


@query
def lexicon_convert(spark, sf):
    lines = _lines(spark, sf)
    out = lexicon.convert(_stored_pairs(spark, sf), "pos", "num_col", lexicon.reading_lexicon(lines))
    return out.select("pos", "num_col", "converted")


@query
def lexicon_convert_back(spark, sf):
    lines = _lines(spark, sf)
    lex = lexicon.reading_lexicon(lines, examples.TEXT_TO_NUM)
    out = lexicon.convert(_stored_pairs(spark, sf), "pos", "sen_col", lex)
    return out.select("pos", "sen_col", "converted")


@query
def lexicon_eval(spark, sf):
    """Converted numerals of the valid split scored against the spelled-out side.

    The lexicon is learned from lines whose pair, by its numerals, is not in that split.
    """
    lines = _lines(spark, sf)
    # each line is judged once, for the split and for the lines to leave out
    valid = storage.materialise(pairs.valid_pairs(lines).select("pos", "num_col", "sen_col"), "valid-pairs")
    held = pairs.head_split(pairs.dedup_pairs(valid)).where("split = 'valid'")
    # a line is left out if its pair is held, wherever it stands
    known = valid.join(held.select("num_col"), "num_col", "left_semi").select("pos")
    lines = lines.join(known, "pos", "left_anti")
    converted = lexicon.convert(held, "pos", "num_col", lexicon.reading_lexicon(lines))
    out = storage.materialise(converted, "converted")
    scored = out.select("pos", F.col("converted").alias("pred"), F.col("sen_col").alias("ref"))
    return _rounded(metrics.evaluate(scored, ["pos"]))


# --- streaming ---


@query
def stream_ingest(spark, sf):
    """Pairs appended by a stream over the ``.trn`` files."""
    base = f"{storage.shared_dir(spark)}/stream-{storage.fresh_name()}"
    lines = ingest.stream_trn(spark, _trn_folder(spark, sf), "*_scripts")
    ingest.append_pairs(lines, f"{base}/out", f"{base}/state").awaitTermination()
    return ingest.read_appended(spark, f"{base}/out").select("num_col", "sen_col")


@query
def stream_dedup(spark, sf):
    """Running keyed dedup over several triggers, final state; equals ``trn_file_pairs``."""
    base = f"{storage.shared_dir(spark)}/stream-{storage.fresh_name()}"
    lines = ingest.stream_trn(spark, _trn_folder(spark, sf), "*_scripts", files_per_trigger=1)
    ingest.write_dedup(lines, f"{base}/out", f"{base}/state").awaitTermination()
    return ingest.read_dedup(spark, f"{base}/out").select("num_col", "sen_col")
