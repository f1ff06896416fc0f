"""The recursive SQL for similarity agrees with difflib on hard pairs."""

import random
from difflib import SequenceMatcher

import duckdb

from dualscript.plans.oracles import _with


def test_recursive_sql_is_difflib():
    rng = random.Random(11)
    rows = []
    for i in range(60):
        alphabet = rng.choice(["ab", "가나다 1", "abcdefghijkl"])
        a = "".join(rng.choice(alphabet) for _ in range(rng.randint(1, 120)))
        b = "".join(rng.choice(alphabet) for _ in range(rng.randint(1, 240)))
        rows.append((i, a, a[: rng.randint(0, 40)] + b if i % 3 else b))
    rows += [(100, "", ""), (101, "a", ""), (102, "가" * 90, "가" * 80 + "나")]
    con = duckdb.connect()
    con.execute("CREATE TABLE given (pair_id BIGINT, num_col VARCHAR, sen_col VARCHAR)")
    con.executemany("INSERT INTO given VALUES (?, ?, ?)", rows)
    sql = _with("SELECT pair_id, round(ratio, 6) AS ratio FROM ratios")
    start = sql.index("pair_rows AS (")
    depth, end = 0, start
    for end in range(start, len(sql)):
        depth += (sql[end] == "(") - (sql[end] == ")")
        if sql[end] == ")" and depth == 0:
            break
    sql = sql[:start] + "pair_rows AS (SELECT * FROM given" + sql[end:]
    got = dict(con.execute(sql).fetchall())
    want = {i: round(SequenceMatcher(None, a.encode(), b.encode()).ratio(), 6) for i, a, b in rows}
    assert got == want
