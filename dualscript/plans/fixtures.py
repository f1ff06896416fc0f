"""Input tables derived from the driver's tables.

One SQL text per table, valid in Spark and in DuckDB; ``{name}`` marks a source.
"""

from __future__ import annotations

from string import Formatter

from pyspark.sql import DataFrame, SparkSession

from dualscript.sources.storage import materialise, spread

QUOTA = {"src1.d": 1, "src2.d": 2, "src3.d": 1, "src4.d": 3, "src99.d": 1}

_READ = "translate(CAST({} AS STRING), '0123456789', '영일이삼사오육칠팔구')"

FIXTURES = {
    "trn_lines": f"""
SELECT o_orderkey AS line_id,
  concat('set', CAST(o_orderkey % 3 AS STRING), '_scripts/train.trn') AS file,
  concat('wav/', k, '.pcm :: ', CASE o_orderkey % 11
    WHEN 0 THEN concat('o/ order (', k, ')/(', r, ') ready')
    WHEN 1 THEN concat('(ab)/(', k, ') (', k, ')/(', r, ') x')
    WHEN 2 THEN concat(k, ' out (', k, ')/(', r, ')')
    WHEN 3 THEN concat('(', k, ') odd')
    WHEN 4 THEN 'b/ no bracket here'
    WHEN 5 THEN concat('(', k, '%)/(', r, '%) rate')
    WHEN 6 THEN concat('(', k, '#)/(', r, '샵) , + sharp   gap')
    WHEN 7 THEN concat('(', CAST(o_custkey % 50 AS STRING), '번)/(', r, ' 번) dup')
    WHEN 8 THEN '(no)/(digit) (either)/(side)'
    WHEN 9 THEN concat('u/(', k, '%)/(', r, ' 퍼센트) and (', CAST(o_custkey AS STRING), ')/(', rc, ')?')
    ELSE concat('hello/ (ab)/(cd) (', k, ')/(', r, ')') END) AS raw
FROM (SELECT *, CAST(o_orderkey AS STRING) AS k, {_READ.format('o_orderkey')} AS r,
        {_READ.format('o_custkey')} AS rc FROM {{orders}}) t""",
    "raw_files": """
SELECT doc_id,
  concat('/raw/', CASE WHEN doc_id % 5 = 0 THEN '2.Validation' ELSE '1.Training' END, '/', source, '.d/G',
         CAST(doc_id % 3 AS STRING), '/S', CAST(doc_id % 7 AS STRING)) AS dir,
  concat(CAST(doc_id AS STRING), CASE WHEN doc_id % 11 = 0 THEN '.wav' ELSE '.txt' END) AS file_name,
  CASE WHEN doc_id % 13 = 0 THEN '  ' ELSE text END AS text
FROM {documents}""",
    "scenarios": """
SELECT source AS scenario, CASE length(source) % 3 WHEN 0 THEN '한국전자통신연구원'
  WHEN 1 THEN '티맥스소프트' ELSE '솔루게이트' END AS vendor, count(*) AS n_files
FROM {documents} GROUP BY source""",
    "pair_rows": f"""
SELECT id AS pair_id,
  CASE id % 7 WHEN 0 THEN concat(k, '번 ', b) WHEN 1 THEN concat(k, ' 가나다') WHEN 2 THEN concat(k, ' abc')
    WHEN 3 THEN concat(b, ' ', k, '번') WHEN 4 THEN concat('가', k, '나') WHEN 5 THEN concat(k, '.')
    ELSE concat(repeat('가나다라', 20), k, '나') END AS num_col,
  CASE id % 7 WHEN 0 THEN concat(r, '번 ', b) WHEN 1 THEN b WHEN 2 THEN '하나둘셋'
    WHEN 3 THEN concat('다른 ', replace(b, 'e', '가')) WHEN 4 THEN '다라' WHEN 5 THEN concat('끝', '.')
    ELSE concat('나다라', repeat('가나다라', 19), r, '다') END AS sen_col
FROM (SELECT id, replace(text, chr(10), ' ') AS b, CAST(id AS STRING) AS k, {_READ.format('id')} AS r
      FROM (SELECT conv_id * 1000 + turn AS id, text FROM {{conversations}}) c) t""",
    # whole documents; native rules decide every row, so no text is compared
    "doc_pair_rows": f"""
SELECT id AS pair_id,
  CASE id % 4 WHEN 0 THEN concat(k, '번 ', b) WHEN 1 THEN concat(b, ' ', k, '번')
    WHEN 2 THEN concat(b, repeat('가나다라', 20), k, '나') ELSE '' END AS num_col,
  CASE id % 4 WHEN 0 THEN concat(r, '번 ', b) WHEN 1 THEN concat(r, ' ', b, '번') WHEN 2 THEN '끝' ELSE b END AS sen_col
FROM (SELECT doc_id AS id, replace(coalesce(text, ''), chr(10), ' ') AS b, CAST(doc_id AS STRING) AS k, {_READ.format('doc_id')} AS r
      FROM {{documents}}) t""",
    "pred_ref": """
SELECT a.conv_id, a.turn, replace(a.text, chr(10), ' ') AS ref,
  replace(CASE WHEN a.turn % 2 = 0 THEN replace(a.text, ' the ', ' ')
               ELSE concat(coalesce(b.text, ''), ' ', a.text) END, chr(10), ' ') AS pred
FROM {conversations} a LEFT JOIN {conversations} b ON a.conv_id = b.conv_id AND b.turn = a.turn - 1""",
}


def sources(name: str) -> list[str]:
    return sorted({f for _, f, _, _ in Formatter().parse(FIXTURES[name]) if f})


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


_STORED: dict[tuple[str, str, str], DataFrame] = {}


def fixture(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A derived table, stored once per session like any other input table."""
    key = (spark.sparkContext.applicationId, sf_dir, name)
    if key not in _STORED:
        frames = {s: spread(table(spark, sf_dir, s)) for s in sources(name)}
        _STORED[key] = materialise(spark.sql(FIXTURES[name], **frames), name)
    return _STORED[key]


def fixture_sql(name: str) -> str:
    return FIXTURES[name].format(**{s: s for s in sources(name)})
