"""SQL counterparts of the flows, in DuckDB's dialect, over the tables the files were made from."""

from __future__ import annotations

from dualscript.plans.flows import LATER
from dualscript.plans.oracles import _ALL, _SIDES, NOT_WS, SEED, _profile, _with

_TREE = r"""SELECT string_split(dir, '/')[3] AS folder, 'domain=' || string_split(dir, '/')[4] || '/g=' || string_split(dir, '/')[5]
      || '/s=' || string_split(dir, '/')[6] AS rel, string_split(dir, '/')[4] AS domain, string_split(dir, '/')[5] AS g,
      string_split(dir, '/')[6] AS s, contains(file_name, '.txt') AS is_text, coalesce(text, '') || chr(10) AS body FROM raw_files"""
_EARLY = "domain IN ('src0.d', 'src1.d', 'src2.d', 'src3.d', 'src4.d')"
_LATE = "regexp_matches(domain, '^src[5-9]') AND g <> 'G1' AND s IN ('S0', 'S1', 'S2', 'S3', 'S4', 'S5')"
_FILES = f"""SELECT *, CASE WHEN {_EARLY} THEN 'early' ELSE 'late' END AS scenario FROM in_tree WHERE {_EARLY} OR {_LATE}"""
_QUOTAS = "SELECT 'early' AS scenario, domain, n_dev FROM quota UNION ALL SELECT * FROM (VALUES " + ", ".join(
    f"('late', '{d}', {n})" for d, n in LATER.items()) + ") q(scenario, domain, n_dev)"
_HELD = f"""SELECT domain, rel FROM (SELECT f.domain, rel, n_dev, row_number() OVER (PARTITION BY f.scenario, f.domain ORDER BY md5('{SEED}|' || rel), rel) AS rn
    FROM (SELECT DISTINCT scenario, domain, rel FROM tree_files WHERE folder = '1.Training') f
    JOIN quotas q ON q.scenario = f.scenario AND q.domain = f.domain) WHERE rn <= n_dev"""
_SCRIPTS = f"""SELECT CASE WHEN folder = '2.Validation' THEN 'eval' WHEN rel IN (SELECT rel FROM tree_held) THEN 'dev' ELSE 'train' END AS split, body
    FROM tree_files WHERE is_text AND regexp_matches(body, '{NOT_WS}')"""
_MORE = {"in_tree": _TREE, "tree_files": _FILES, "quotas": _QUOTAS, "tree_held": _HELD, "scripts": _SCRIPTS}


def _tree(sql: str) -> str:
    return _with(sql, **_MORE)


_IDS = """list_transform(range(0, 4), lambda k: 4 + list_position({x}[k * q + 1:k * q + q], list_max({x}[k * q + 1:k * q + q])))"""
_WORDS = """SELECT vec_id, string_agg(token, ' ' ORDER BY i) AS t FROM (
    SELECT vec_id, unnest(ids) AS id, generate_subscripts(ids, 1) AS i FROM ({ids})) JOIN vocab USING (id) GROUP BY vec_id"""
_VECTORS = "(SELECT vec_id, len(embedding) // 4 AS q, embedding AS e, list_transform(embedding, lambda x: abs(x)) AS a FROM embeddings)"

ORACLES = {
    "tree_listing": _tree("""SELECT rel, count(*) AS n_files, CAST(sum(CASE WHEN is_text THEN strlen(body) ELSE 0 END) AS BIGINT) AS n_bytes
        FROM tree_files WHERE folder = '1.Training' AND scenario = 'early' GROUP BY rel"""),
    "tree_holdout": _tree("SELECT domain, rel FROM tree_held"),
    # texts end in a line feed, which joining keeps; a file's last one ends its last line
    "tree_scripts": _tree("""SELECT * FROM (SELECT split, line, count(*) - CASE WHEN line = '' THEN 1 ELSE 0 END AS n
        FROM (SELECT split, unnest(string_split(body, chr(10))) AS line FROM (SELECT DISTINCT split, body FROM scripts)) GROUP BY split, line) WHERE n > 0"""),
    "tree_report": _tree("""SELECT split AS what, count(*) AS n_total, count(DISTINCT body) AS n_unique FROM scripts GROUP BY split
        UNION ALL SELECT 'other vendor not supported: 한국전자통신연구원', NULL, NULL"""),
    "smallest_names": _with(r"""SELECT line_id, (SELECT min(n) FROM (SELECT unnest(list_transform(range(1, len(d) + 1), lambda k: substr(d, k))) || '.' AS n) x
        WHERE (left(n, 1) <> '0' OR n = '0.') AND CAST(rtrim(n, '.') AS BIGINT) < 50000) AS name
        FROM (SELECT line_id, regexp_extract(raw, '^wav/([0-9]+)\.pcm', 1) AS d FROM trn_lines)"""),
    "csv_rejects": _with("""SELECT CASE line_id % 5 WHEN 0 THEN k WHEN 1 THEN k || ',a,b' ELSE '"' || k || ',x",y,"z"' END AS line,
        CASE line_id % 5 WHEN 0 THEN 'too few fields' ELSE 'too many fields' END AS reason
        FROM (SELECT line_id, CAST(line_id AS VARCHAR) AS k FROM trn_lines) WHERE line_id % 5 IN (0, 1, 4)"""),
    "csv_clean": _with("""SELECT num_col, sen_col, 'kept' AS kind FROM doc_kept UNION ALL
        SELECT num_col, sen_col, 'quarantine' FROM doc_pair_rows WHERE (num_col = '') <> (sen_col = '')"""),
    "csv_clean_profile": _with(f"""SELECT 'before' AS phase, b.* FROM ({_profile('doc_pair_rows', _SIDES, 4)}) b
        UNION ALL SELECT 'after', a.* FROM ({_profile('doc_kept', _SIDES, 4)}) a"""),
    "csv_clean_sizes": _with("""SELECT CASE WHEN (num_col = '') <> (sen_col = '') THEN 'quarantine'
        WHEN pair_id IN (SELECT pair_id FROM doc_kept) THEN 'keep' ELSE 'drop' END AS verdict, count(*) AS n FROM doc_pair_rows GROUP BY 1"""),
    "split_load": _with("SELECT num_col, sen_col, split FROM split"),
    "metrics_file": _with(_ALL),
    "logits_eval": _with(_ALL, scored=f"""SELECT p.vec_id AS row_id, p.vec_id AS conv_id, 0 AS turn, p.t AS pred, r.t AS ref
        FROM ({_WORDS.format(ids=f"SELECT vec_id, {_IDS.format(x='a')} AS ids FROM {_VECTORS}")}) p
        JOIN ({_WORDS.format(ids=f"SELECT vec_id, ({_IDS.format(x='e')})[1:3] AS ids FROM {_VECTORS}")}) r USING (vec_id)"""),
}
