"""Whitespace vocabulary: build, encode, decode."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dualscript.functions import arrays as A
from dualscript.functions import text as T
from dualscript.operators.lookup import grouped_lookup
from dualscript.operators.ranking import number_rows
from dualscript.sources.storage import materialise

# --- fixed values: reserved tokens; their ids are their positions ---
SPECIALS = ("<s>", "</s>", "<unk>", "<pad>", "<mask>")
BOS, EOS, UNK, PAD, MASK = range(len(SPECIALS))
# --- end of fixed values ---


def token_counts(df: DataFrame, *columns: str) -> DataFrame:
    """Occurrences of each whitespace token over all ``columns``."""
    every = F.flatten(F.array(*[T.tokens(F.col(c)) for c in columns]))
    return (
        df.select(F.explode(every).alias("token"))
        .where(~F.col("token").isin(*SPECIALS))
        .groupBy("token").agg(F.count("*").alias("n"))
    )


def build_vocab(df: DataFrame, *columns: str) -> DataFrame:
    """``id, token, n``: reserved tokens first, then by falling count and token."""
    counted = number_rows(
        token_counts(df, *columns), [F.desc("n"), F.asc("token")], "id", len(SPECIALS)
    )
    reserved = df.sparkSession.createDataFrame(
        [(i, t, 0) for i, t in enumerate(SPECIALS)], "id bigint, token string, n bigint"
    )
    return materialise(reserved.unionByName(counted.select("id", "token", "n")), "vocabulary")


def encode_texts(df: DataFrame, key: str, texts: dict[str, str], vocab: DataFrame, closed: bool = False) -> DataFrame:
    """``key`` and, per entry ``name: text column``, the token ids of that text.

    ``key`` must be unique.  All texts share one lookup and one regrouping.
    Unknown tokens become ``<unk>``, and so do reserved tokens that a text
    spells out; with ``closed`` the caller knows that the
    vocabulary holds all tokens, and no pass looks for frequent unknown ones.
    The texts move once, and of the tokens only rare ones that a vocabulary
    above the broadcast threshold cannot answer where the texts are.
    """
    table = vocab.where(F.col("id") >= len(SPECIALS)).select("token", F.col("id").cast("int").alias("id"), "n")
    sides = F.array(*[
        F.struct(F.lit(k).alias("side"), T.tokens(F.col(text)).alias("words"))
        for k, text in enumerate(texts.values())
    ])
    placed = _by_key(df.select(key, *dict.fromkeys(texts.values())), key).select(key, F.inline(sides)).select(
        key, "side", F.posexplode_outer("words").alias("place", "token")
    )
    item = F.struct("place", F.coalesce("id", F.lit(UNK)).alias("id"))
    lists = {name: F.when((F.col("side") == k) & F.col("place").isNotNull(), item) for k, name in enumerate(texts)}
    found = grouped_lookup(placed, table, ["token"], "n", key, [key, "side", "place"], lists, may_miss=not closed)
    return found.select(key, *[F.transform(name, lambda x: x["id"]).alias(name) for name in texts])


def _by_key(df: DataFrame, key: str) -> DataFrame:
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), key)


def end_ids(ids: Column, add_eos: bool = True, max_length: int | None = None) -> Column:
    """Cut to ``max_length``, the end-of-sequence id included."""
    if max_length is not None:
        ids = A.truncate(ids, max_length - int(add_eos))
    return A.append_id(ids, EOS) if add_eos else ids


def encode(
    df: DataFrame, key: str, text: str, vocab: DataFrame, add_eos: bool = False,
    max_length: int | None = None, closed: bool = False,
) -> DataFrame:
    """``key, ids``: token ids of one text in order."""
    out = encode_texts(df, key, {"ids": text}, vocab, closed)
    return out.withColumn("ids", end_ids(F.col("ids"), add_eos, max_length))


def decode_lists(df: DataFrame, key: str, ids: dict[str, str], vocab: DataFrame) -> DataFrame:
    """``key`` and, per entry ``name: column of ids``, their tokens joined by spaces, reserved ids skipped.

    ``key`` must be unique.  All columns share one lookup and one regrouping.
    """
    columns = dict.fromkeys(ids.values())
    sides = F.array(*[F.struct(F.lit(k).alias("side"), F.col(c).alias("ids")) for k, c in enumerate(ids.values())])
    placed = _by_key(df.select(key, *columns), key).select(key, F.inline(sides)).select(
        key, "side", F.posexplode_outer("ids").alias("place", "id")
    ).withColumn("id", F.when(F.col("id") >= len(SPECIALS), F.col("id").cast("bigint")))
    item = F.struct("place", "token")
    lists = {name: F.when((F.col("side") == k) & F.col("token").isNotNull(), item) for k, name in enumerate(ids)}
    found = grouped_lookup(placed, vocab.select("id", "token", "n"), ["id"], "n", key, [key, "side", "place"], lists)
    return found.select(key, *[F.array_join(F.transform(name, lambda x: x["token"]), " ").alias(name) for name in ids])


def decode(df: DataFrame, key: str, ids: str, vocab: DataFrame) -> DataFrame:
    """``key, text``: tokens of an id array joined by spaces, reserved ids skipped."""
    return decode_lists(df, key, {"text": ids}, vocab)
