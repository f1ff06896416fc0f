"""Pairs from whole documents."""

from pyspark.sql import functions as F

from dualscript.operators import curate
from dualscript.plans.fixtures import fixture, table
from dualscript.plans.queries import QUERIES

SF = "/root/testdata/sf0.001"


def test_whole_documents_reach_the_profiles(spark):
    longest, n = table(spark, SF, "documents").agg(F.max(F.length("text")), F.count("*")).first()
    rows = fixture(spark, SF, "doc_pair_rows")
    assert rows.count() == n
    for name in ("length_eda_before_docs", "length_eda_after_docs"):
        assert max(r["max"] for r in QUERIES[name](spark, SF).collect()) >= min(longest, 5_000)
    sizes = QUERIES["text_sizes_docs"](spark, SF).agg(F.max(F.greatest("num_chars", "n_chars"))).first()[0]
    assert sizes >= longest
    assert QUERIES["csv_union_docs"](spark, SF).where(F.length("sen_col") >= 5_000).count() > 0


def test_native_rules_decide_every_document_pair(spark):
    judged = curate.native_verdicts(fixture(spark, SF, "doc_pair_rows"))
    assert {r["verdict"] for r in judged.select("verdict").distinct().collect()} == {"keep", "drop", "quarantine"}
