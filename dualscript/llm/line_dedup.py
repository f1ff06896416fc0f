"""Line dedup: drop lines that many documents share, but for the largest document."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dualscript.llm.common import LOWER, UPPER, WHITE, let, pack, unpack
from dualscript.sources.storage import materialise

HOT_SHARE = 1_000  # a key above 1 / HOT_SHARE of all shared lines is broadcast; at most so many are


def line_key(line: Column) -> Column:
    return F.translate(F.btrim(line, F.lit(WHITE)), UPPER, LOWER)


def lines_of(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def line_places(packed: DataFrame, min_chars: int) -> DataFrame:
    """One row per long line: its document, place and a 128-bit hash of its key.

    Lower-casing A-Z keeps the length, so the length test needs only the trim.
    """
    lines = packed.select("_id", F.xxhash64("_text").alias("_row"),
                          F.posexplode(lines_of(F.col("_text"))).alias("_pos", "_line"))
    key = line_key(F.col("_line"))
    return lines.where(
        (F.char_length("_line") >= min_chars)
        & (F.char_length(F.btrim("_line", F.lit(WHITE))) >= min_chars)
    ).select("_id", "_row", "_pos", F.xxhash64(key).alias("_h1"), F.xxhash64(F.lit(1), key).alias("_h2"))


def without(lines: Column, drop: Column) -> Column:
    """``lines`` without the ascending 0-based places ``drop``, in linear time."""
    cuts = F.concat(F.array(F.lit(-1)), drop, F.array(F.size(lines)))
    bound = F.struct(lines.alias("lines"), cuts.alias("cuts"))
    return let(bound, lambda s: F.flatten(F.transform(
        F.sequence(F.lit(0), F.size(s["cuts"]) - 2),
        lambda i: F.slice(s["lines"], F.get(s["cuts"], i) + 2,
                          F.get(s["cuts"], i + 1) - F.get(s["cuts"], i) - 1))))


def shared_lines(docs: DataFrame, key: str = "doc_id", text: str = "text", min_chars: int = 40,
                 min_docs: int = 5) -> DataFrame:
    """``_id, _text, _rest, n_lines, n_dropped, kept_text`` for every row of ``docs``.

    Lines are split at ``\\n``.  A line whose key (white space stripped, A-Z in
    lower case) has ``min_chars`` code points and is found in ``min_docs``
    documents goes, except from the largest ``key`` that holds it.

    Documents are counted by distinct non-null key values.  Rows with a null
    key are no documents of the count and never keep a shared line; equal rows
    get equal results; a null or empty text is one empty line; an empty table
    gives an empty result.  Other columns stay in ``_rest`` whatever their names.

    Only hashes and places are shuffled to find the lines, and texts once, to
    meet their places.  Keys on more than 1 / 1000 of all shared lines (at most
    1000 of them) are broadcast, so no task gathers a frequent line.
    """
    packed = pack(docs, key, text)
    places = materialise(line_places(packed, min_chars), "line-places")
    counted = places.groupBy("_h1", "_h2").agg(
        F.count_distinct("_id").alias("n"), F.max("_id").alias("keeper")).where(F.col("n") >= min_docs)
    counted = materialise(counted, "line-counts")
    total = counted.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    is_hot = F.col("n") * HOT_SHARE > total
    found = F.struct(F.lit(True).alias("shared"), "keeper")
    hot = counted.where(is_hot).select("_h1", "_h2", found.alias("_hot"))
    cold = counted.where(~is_hot).select("_h1", "_h2", found.alias("_found"))
    tagged = places.join(F.broadcast(hot), ["_h1", "_h2"], "left")
    answered = tagged.where("_hot is not null").select("_id", "_row", "_pos", F.col("_hot").alias("_found"))
    others = tagged.where("_hot is null").join(cold, ["_h1", "_h2"]).select("_id", "_row", "_pos", "_found")
    gone = answered.unionByName(others).where(~F.col("_id").eqNullSafe(F.col("_found.keeper")))
    drops = gone.groupBy("_id", "_row").agg(F.array_sort(F.collect_set("_pos")).alias("_drop"))
    d = drops.select(F.col("_id").alias("_did"), F.col("_row").alias("_drow"), "_drop")
    # Documents without a drop keep their text; a null id must find its drops too.
    joined = packed.withColumn("_row", F.xxhash64("_text")).join(
        d, F.col("_id").eqNullSafe(F.col("_did")) & (F.col("_row") == F.col("_drow")), "left")
    whole = F.coalesce("_text", F.lit(""))
    return joined.select(
        "_id", "_text", "_rest",
        (F.char_length(whole) - F.char_length(F.replace(whole, F.lit("\n"), F.lit(""))) + 1).cast("long").alias("n_lines"),
        F.coalesce(F.size("_drop"), F.lit(0)).cast("long").alias("n_dropped"),
        F.when(F.col("_drop").isNull(), F.col("_text"))
        .otherwise(F.array_join(without(lines_of(F.col("_text")), F.col("_drop")), "\n")).alias("kept_text"),
    )


def drop_shared_lines(docs: DataFrame, key: str = "doc_id", text: str = "text", size: str | None = None,
                      **limits) -> DataFrame:
    """``docs`` with the shared lines taken out of ``text``; ``size`` is its length, if kept."""
    out = shared_lines(docs, key, text, **limits)
    changed = {text: F.col("kept_text")}
    if size in docs.columns:
        changed[size] = F.when(F.col("n_dropped") > 0, F.char_length("kept_text")).otherwise(
            F.col("_rest")[size]).cast(docs.schema[size].dataType)
    return unpack(out, docs, key, text, changed)
