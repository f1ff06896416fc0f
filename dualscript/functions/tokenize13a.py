"""The public mteval-13a word tokenisation as a regexp chain."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from dualscript.functions import text as T

# --- fixed values: rules of the published mteval-13a tokenisation, in order ---
UNESCAPE = [("&quot;", '"'), ("&amp;", "&"), ("&lt;", "<"), ("&gt;", ">")]
RULES = [
    (r"([\{-\~\[-\` -\&\(-\+\:-\@\/])", " $1 "),
    (r"([^0-9])([\.,])", "$1 $2 "),
    (r"([\.,])([^0-9])", " $1 $2"),
    (r"([0-9])(-)", "$1 $2 "),
]
# --- end of fixed values ---


def tokens_13a(line: Column) -> Column:
    out = F.replace(line, F.lit("<skipped>"), F.lit(""))
    out = F.replace(F.replace(out, F.lit("-\n"), F.lit("")), F.lit("\n"), F.lit(" "))
    for entity, char in UNESCAPE:
        out = F.replace(out, F.lit(entity), F.lit(char))
    out = F.concat(F.lit(" "), out, F.lit(" "))
    for pattern, replacement in RULES:
        out = F.regexp_replace(out, pattern, replacement)
    return T.tokens(out)
