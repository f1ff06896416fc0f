import pytest

import __spark_entry__ as driver
from dualscript.plans import flows
from dualscript.plans.queries import QUERIES
from tools.check import connect, rows

SF = driver.SMOKE_DIR


#: Compared with brute force in test_curate.py; the recursive SQL takes minutes.
WITHOUT_SQL = {"rouge_lsum_rows"}  # which of several common subsequences counts is a rule of its own


def test_every_query_has_sql():
    assert {*QUERIES, *flows.QUERIES} - set(driver.oracle_sql()) == WITHOUT_SQL
    assert set(driver.oracle_sql()) <= set(driver.queries())


def test_flagship(spark):
    df = driver.entry(spark)
    assert set(df.columns) == {"num_col", "sen_col", "pos"} and df.count() > 0


@pytest.mark.parametrize("name", ["sentence_pairs", "pair_split", "pair_filter", "dev_scripts", "rouge_l_rows", "text_sizes"])
def test_query_matches_sql(spark, name):
    df = driver.queries()[name](spark, SF)
    cur = connect(SF).execute(driver.oracle_sql()[name])
    names = [d[0] for d in cur.description]
    assert rows(df.columns, df.collect()) == rows(names, cur.fetchall())
