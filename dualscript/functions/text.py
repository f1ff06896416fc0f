"""String functions for dual transcriptions.

Every function maps Columns to Columns and stays inside the JVM.  Python's
``\\s`` and ``\\d`` are Unicode classes while Java's are ASCII, so the classes
are spelled out here once and used everywhere.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- fixed values: character classes and symbol rules of the corpus format ---
# The 29 code points that Python treats as whitespace, all below U+3001.
WS_CHARS = "".join(c for c in map(chr, range(0x3001)) if c.isspace())
WS_BODY = r"\t\n\x0B\f\r\x1c-\x1f\x85\p{Z}"
WS = f"[{WS_BODY}]"
NOT_WS = f"[^{WS_BODY}]"
DIGIT = r"\p{Nd}"
HANGUL = "[가-힣]"
BRACKET = r"\([^)\n]*\)"
# A noise letter directly before a slash marks a non-speech event; the other
# symbols, the slash included, are removed wherever they stand.
NOISE_OR_SYMBOL = r"[onubl]/|[/+*@$^&\[\];,]"
# '#' is read aloud as this syllable.
SHARP = "샾"
# --- end of fixed values ---

MODES = ("spelling", "phonetic")


def _check_mode(mode: str) -> None:
    if mode not in MODES:
        raise ValueError(f"mode is {mode!r}, must be one of {MODES}")


def has_digit(text: Column) -> Column:
    """Any Unicode decimal digit."""
    return text.rlike(DIGIT)


def is_blank(text: Column) -> Column:
    """Empty, or nothing but Unicode whitespace."""
    return ~text.rlike(NOT_WS)


def strip(text: Column) -> Column:
    """Unicode-aware strip; ``trim`` alone only removes U+0020."""
    return F.btrim(text, F.lit(WS_CHARS))


def squeeze(text: Column) -> Column:
    """Strip, then turn each run of two or more whitespace characters into a space.

    A lone tab inside the text stays a tab.
    """
    return F.regexp_replace(strip(text), WS + "{2,}", " ")


def tokens(text: Column) -> Column:
    """Whitespace tokens, no empty strings."""
    return F.array_remove(F.split(strip(text), WS + "+"), "")


def field_after(raw: Column, delimiter: str) -> Column:
    """The second delimited field, NULL when the delimiter is absent."""
    mark = F.lit(delimiter)
    rest = F.substr(raw, F.locate(delimiter, raw) + len(delimiter))
    return F.when(F.contains(raw, mark), F.substring_index(rest, delimiter, 1))


def drop_brackets(text: Column) -> Column:
    return F.regexp_replace(text, r"\([^)]*\)", "")


def has_stray_digit(text: Column) -> Column:
    """``has_digit(drop_brackets(text))`` as one search, without the copy.

    Text lies outside brackets from the start or a closing bracket up to the
    next opening one, and after an opening bracket that is never closed.
    """
    # What follows the last closing bracket is outside as a whole.
    tail = F.substring_index(text, ")", -1)
    return text.rlike(rf"(?:\A|\))[^()]*{DIGIT}") | (F.contains(tail, F.lit("(")) & tail.rlike(DIGIT))


def bracket_list(text: Column) -> Column:
    """All bracketed spans in order, brackets included."""
    return F.regexp_extract_all(text, F.lit(BRACKET), F.lit(0))


def is_paired(brackets: Column) -> Column:
    """A positive, even number of brackets, tested in one expression."""
    return (F.size(brackets) - 1) % 2 == 1


def stride_pairs(items: Column) -> Column:
    """``[a, b, c, d] -> [(a, b), (c, d)]``; a trailing single is left out."""
    both = F.zip_with(
        F.filter(items, lambda _, i: i % 2 == 0),
        F.filter(items, lambda _, i: i % 2 == 1),
        lambda a, b: F.struct(a.alias("first"), b.alias("second")),
    )
    return F.filter(both, lambda p: p["second"].isNotNull())


def fold_readings(text: Column, brackets: Column) -> Column:
    """Undo dual transcriptions that carry no numeral.

    For each bracket pair, in order, whose first member has no digit, every
    occurrence of the second member in the running text becomes the first.
    """

    def state(running: Column, first: Column) -> Column:
        return F.struct(running.alias("running"), first.alias("first"))

    none = F.lit("")  # no first member is waiting
    return F.aggregate(
        brackets,
        state(text, none),
        lambda acc, b: F.when(acc["first"] == "", state(acc["running"], b)).otherwise(
            state(
                F.when(has_digit(acc["first"]), acc["running"]).otherwise(
                    F.replace(acc["running"], b, acc["first"])
                ),
                none,
            )
        ),
        lambda acc: acc["running"],
    )


def cut_brackets(text: Column, mode: str) -> Column:
    """Cut the bracket members that ``mode`` does not read, and the marks.

    *phonetic*: an opening bracket starts or ends a cut; one without partner
    stays in the result.  *spelling*: a closing bracket starts or ends a cut,
    which runs to the end of the text if unpaired.
    """
    _check_mode(mode)
    if mode == "phonetic":
        return F.regexp_replace(text, r"\([^(]*\(|\)", "")
    return F.regexp_replace(text, r"\)[^)]*(?:\)|\z)|\(", "")


def bracket_text(text: Column, mode: str) -> Column:
    """Keep one member of every bracket pair plus the text outside.

    NULL in *phonetic* mode when the opening brackets do not pair up.
    """
    cut = cut_brackets(text, mode)
    return F.when(~F.contains(cut, F.lit("(")), cut) if mode == "phonetic" else cut


def drop_symbols(text: Column) -> Column:
    """Remove noise tags and symbols, then squeeze whitespace."""
    plain = F.regexp_replace(text, NOISE_OR_SYMBOL, "")
    return squeeze(F.replace(plain, F.lit("#"), F.lit(SHARP)))


def clean_symbols(text: Column, mode: str, percent: str | None = None) -> Column:
    """``drop_symbols`` with the rule for '%'.

    *spelling* keeps it.  In *phonetic* mode it has no reading of its own: it
    becomes ``percent``, and without one the result is NULL.
    """
    _check_mode(mode)
    if mode == "spelling":
        return drop_symbols(text)
    if percent is None:
        return F.when(~F.contains(text, F.lit("%")), drop_symbols(text))
    plain = F.replace(F.regexp_replace(text, NOISE_OR_SYMBOL, ""), F.lit("#"), F.lit(SHARP))
    return squeeze(F.replace(plain, F.lit("%"), F.lit(percent)))


def transcript_text(text: Column, mode: str, percent: str | None = None) -> Column:
    """``clean_symbols`` of ``bracket_text``."""
    return clean_symbols(bracket_text(text, mode), mode, percent)


def last_char(text: Column) -> Column:
    return F.substring(text, -1, 1)


def is_hangul(char: Column) -> Column:
    return char.rlike(HANGUL)


def utf8(text: Column) -> Column:
    return F.encode(text, "UTF-8")


def unit_hash(key: Column, seed: str) -> Column:
    """Uniform value in [0, 1) from a seeded digest; the same in any engine."""
    digest = F.md5(F.concat(F.lit(seed + "|"), key))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("double") / F.lit(float(2**32))


def path_dir(path: Column) -> Column:
    return F.regexp_extract(path, r"^(.*)/[^/]*\z", 1)


def path_name(path: Column) -> Column:
    return F.element_at(F.split(path, "/"), -1)


def join_path(*parts: Column) -> Column:
    return F.concat_ws("/", *parts)
