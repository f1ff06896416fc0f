"""Reading lexicon: learn numeral readings from transcripts, apply, score."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dualscript.functions import text as T
from dualscript.operators.examples import NUM_TO_TEXT
from dualscript.operators.lookup import balanced_lookup, fits_broadcast
from dualscript.operators.pairs import sentences
from dualscript.operators.staging import compute_once
from dualscript.sources.storage import materialise

# A dual transcription: the spelling, then the reading.
DUAL = r"\(([^()\n]*)\)/\(([^()\n]*)\)"


def readings(lines: DataFrame, delimiter: str | None = "::") -> DataFrame:
    """``num, reading, next_token``: every numeral with how it was read.

    Both forms are extended to whole whitespace tokens by what is written
    directly before and after the brackets, and cleaned like sentence pairs.
    ``next_token`` is the token that follows, empty at the end.
    """
    s = F.col("sentence")
    marked = sentences(lines.where(F.contains(F.col("raw"), F.lit(")/("))), delimiter)
    parts = compute_once(
        marked.select("sentence"),
        around=F.split(s, DUAL),
        duals=F.regexp_extract_all(s, F.lit(DUAL), F.lit(0)),
    )
    each = parts.select("around", F.posexplode("duals").alias("i", "dual")).select(
        F.get("around", F.col("i")).alias("before"),
        F.get("around", F.col("i") + 1).alias("after"),
        "dual",
    )
    words = compute_once(
        each,
        prefix=F.regexp_extract("before", rf"({T.NOT_WS}*)\z", 1),
        suffix=F.regexp_extract("after", rf"^({T.NOT_WS}*)", 1),
        following=F.regexp_extract("after", rf"^{T.NOT_WS}*{T.WS}+({T.NOT_WS}+)", 1),
        num=F.regexp_extract("dual", DUAL, 1),
        reading=F.regexp_extract("dual", DUAL, 2),
    )
    whole = compute_once(
        words,
        num=F.concat("prefix", "num", "suffix"),
        reading=F.concat("prefix", "reading", "suffix"),
    ).where(T.has_digit(F.col("num")) & ~F.contains(F.col("reading"), F.lit("%")))
    return compute_once(
        whole.select("num", "reading", "following"),
        num=T.drop_symbols(F.col("num")),
        reading=T.drop_symbols(F.col("reading")),
        next_token=T.drop_symbols(F.col("following")),
    ).where(F.length("reading") > 0).select("num", "reading", "next_token")


def reading_lexicon(
    lines: DataFrame, direction: str = NUM_TO_TEXT, delimiter: str | None = "::"
) -> DataFrame:
    """``src, next_token, dst, n``: the most frequent rendering of a phrase.

    Rows with a ``next_token`` hold in that context; rows where it is NULL are
    the back-off.  Ties go to the smaller rendering.
    """
    src, dst = ("num", "reading") if direction == NUM_TO_TEXT else ("reading", "num")
    nowhere = F.lit(None).cast("string")
    # Every reading counts for the back-off and, if it has one, for its context.
    contexts = F.when(F.col("next_token") == "", F.array(nowhere)).otherwise(
        F.array(nowhere, F.col("next_token"))
    )
    counted = (
        readings(lines, delimiter)
        .select(F.col(src).alias("src"), F.col(dst).alias("dst"), F.explode(contexts).alias("next_token"))
        .groupBy("src", "next_token", "dst").agg(F.count("*").alias("n"))
    )
    best = F.min(F.struct((-F.col("n")).alias("rank"), "dst"))
    return counted.groupBy("src", "next_token").agg(best.alias("best")).select(
        "src", "next_token", F.col("best.dst").alias("dst"), (-F.col("best.rank")).alias("n")
    )


def _leftmost_longest(matches: Column) -> Column:
    """From matches sorted by place and falling width, those that do not overlap."""
    start = F.struct(F.lit(1).alias("next"), F.filter(matches, lambda m: F.lit(False)).alias("kept"))
    return F.aggregate(
        matches, start,
        lambda acc, m: F.when(m["place"] < acc["next"], acc).otherwise(
            F.struct(
                (m["place"] + m["width"]).alias("next"),
                F.array_append(acc["kept"], m).alias("kept"),
            )
        ),
        lambda acc: acc["kept"],
    )


def _starts(back_off: DataFrame) -> DataFrame:
    """``token, widths, n``: a trie's first level, each first token with the widths of its phrases."""
    words = T.tokens(F.col("phrase"))
    return back_off.select(F.get(words, F.lit(0)).alias("token"), F.size(words).alias("width"), "n").groupBy("token").agg(
        F.sort_array(F.collect_set("width")).alias("widths"), F.sum("n").alias("n"))


def _candidates(texts: DataFrame, key: str, starts: DataFrame) -> DataFrame:
    """``key, place, width, phrase, following``: what may be a phrase, by its first token.

    Each token is probed once.  A text comes back as a row, in which the places
    that may begin a phrase, and only these, spell out as many tokens as a
    phrase that begins so has; a wide entry costs nothing elsewhere.  Texts move
    to their key first only if the tokens then stay there.
    """
    if fits_broadcast(starts):
        texts = texts.repartition(int(texts.sparkSession.conf.get("spark.sql.shuffle.partitions")), key)
    placed = texts.select(key, F.posexplode("words").alias("place", "token"))
    probed = balanced_lookup(placed, starts, ["token"], "n", [key, "place"], may_miss=True)
    item = F.struct("place", "token", "widths")
    rows = probed.groupBy(key).agg(F.sort_array(F.collect_list(item)).alias("items"), F.count("widths").alias("starts"))
    rows = rows.where("starts > 0").select(
        key, F.transform("items", lambda x: x["token"]).alias("words"),
        F.explode(F.filter("items", lambda x: x["widths"].isNotNull())).alias("item"))
    rows = rows.select(key, "words", (F.col("item.place") + 1).alias("place"), F.explode("item.widths").alias("width"))
    fits = rows.where(F.col("place") + F.col("width") - 1 <= F.size("words"))
    return fits.select(
        key, "place", "width", F.array_join(F.slice("words", F.col("place"), F.col("width")), " ").alias("phrase"),
        F.get("words", F.col("place") + F.col("width") - 1).alias("following"))


def convert(df: DataFrame, key: str, text: str, lexicon: DataFrame) -> DataFrame:
    """``df`` with ``converted``: phrases of the lexicon replaced, leftmost longest first.

    The entry for the following token wins over the back-off.  ``key`` must be
    unique.  Phrases are found by their first token and checked by join.  The
    lexicon, read several times, is stored first, and so are the places to
    look up where the lookup reads them twice.
    """
    lexicon = materialise(lexicon, "lexicon")
    back_off = lexicon.where("next_token IS NULL").select(
        F.col("src").alias("phrase"), F.col("dst").alias("any_dst"), "n"
    )
    context = lexicon.where("next_token IS NOT NULL").select(
        F.col("src").alias("phrase"), F.col("next_token").alias("following"),
        F.col("dst").alias("context_dst"), "n",
    )
    words = T.tokens(F.col(text))
    starts = materialise(_starts(back_off), "phrase-starts")
    candidates = _candidates(df.select(key, words.alias("words")), key, starts)
    if not fits_broadcast(back_off):
        candidates = materialise(candidates, "phrase-candidates")
    hits = balanced_lookup(candidates, back_off, ["phrase"], "n", [key, "place"], may_miss=True).where(
        "any_dst IS NOT NULL"
    )
    resolved = balanced_lookup(hits, context, ["phrase", "following"], "n", [key, "place"])
    match = F.struct(
        "place", (-F.col("width")).alias("order"), "width",
        F.coalesce("context_dst", "any_dst").alias("dst"),
    )
    chosen = resolved.groupBy(key).agg(F.sort_array(F.collect_list(match)).alias("matches")).select(
        key, _leftmost_longest(F.col("matches")).alias("kept")
    )
    joined = df.join(chosen, key, "left").withColumn("words", words).withColumn(
        "kept", F.coalesce("kept", F.array().cast(chosen.schema["kept"].dataType))
    )

    def end_of(m: Column) -> Column:
        return m["place"] + m["width"]

    def piece(m: Column, i: Column) -> Column:
        begin = F.when(i == 0, F.lit(1)).otherwise(end_of(F.element_at("kept", i)))
        return F.concat(F.slice("words", begin, m["place"] - begin), F.array(m["dst"]))

    tail_at = F.when(F.size("kept") == 0, F.lit(1)).otherwise(end_of(F.element_at("kept", -1)))
    tail = F.slice("words", tail_at, F.greatest(F.size("words") - tail_at + 1, F.lit(0)))
    pieces = F.concat(F.flatten(F.transform("kept", piece)), tail)
    return joined.withColumn("converted", F.array_join(pieces, " ")).drop("words", "kept")
