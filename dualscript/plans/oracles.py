"""SQL counterparts of the registered queries, in DuckDB's dialect.

They are worded differently from the Spark operators wherever the language
allows: list splits instead of regexps, window ranks instead of counting
searches, recursive queries instead of Python functions.
"""

from __future__ import annotations

import re

from dualscript.plans.fixtures import FIXTURES, QUOTA, fixture_sql

SEED = "7"
WS = r"[\t\n\v\f\r\x1c-\x1f\x{85}\p{Z}]"
NOT_WS = r"[^\t\n\v\f\r\x1c-\x1f\x{85}\p{Z}]"
ND = r"\p{Nd}"
DUAL = r"\(([^()\n]*)\)/\(([^()\n]*)\)"


# --- expressions ---


def keep_odd(x: str, mark: str) -> str:
    return f"array_to_string(list_filter(string_split({x}, '{mark}'), lambda v, i: i % 2 = 1), '')"


def spell(x: str) -> str:
    return f"replace({keep_odd(x, ')')}, '(', '')"


def phon(x: str) -> str:
    return f"CASE WHEN len(string_split({x}, '(')) % 2 = 1 THEN replace({keep_odd(x, '(')}, ')', '') END"


def stripped(x: str) -> str:
    return f"regexp_replace(regexp_replace({x}, '^{WS}+', ''), '{WS}+$', '')"


def squeezed(x: str) -> str:
    return f"regexp_replace({stripped(x)}, '{WS}{{2,}}', ' ', 'g')"


def plain(x: str) -> str:
    return f"translate(regexp_replace({x}, '[onubl]/', '', 'g'), '#/+*@$^&[];,', '샾')"


def clean(x: str) -> str:
    return squeezed(plain(x))


def words(x: str) -> str:
    return f"list_filter(regexp_split_to_array({x}, '{WS}+'), lambda w: w <> '')"


# --- fixed values: the entities and the symbols that the 13a tokens set apart ---
ENTITIES = {"quot": '"', "amp": "&", "lt": "<", "gt": ">"}
APART = "!\"#$%&()*+/:;<=>?@[\\]^_`{|}~"  # wherever they stand
# --- end of fixed values ---


def words_13a(x: str) -> str:
    """Symbols one by one, then points and commas that no digit precedes or follows, then hyphens after a digit."""
    out = f"replace(replace(replace({x}, '<skipped>', ''), '-' || chr(10), ''), chr(10), ' ')"
    for name, char in ENTITIES.items():
        out = f"replace({out}, '&{name};', '{char}')"
    out = f"' ' || {out} || ' '"
    for char in APART:
        out = f"replace({out}, '{char}', ' {char} ')"
    for before, marks, after in (("[^0-9]", "[.,]", ""), ("", "[.,]", "[^0-9]"), ("[0-9]", "-", "")):
        spaced = r"\1 \2 " if before else r" \1 \2"
        groups = "".join(f"({g})" for g in (before, marks, after) if g)
        out = f"regexp_replace({out}, '{groups}', '{spaced}', 'g')"
    return words(out)


# --- named sub-queries ---

CTES = {name: fixture_sql(name) for name in FIXTURES}
CTES |= {
    "quota": "SELECT * FROM (VALUES " + ", ".join(f"('{d}', {n})" for d, n in QUOTA.items()) + ") q(domain, n_dev)",
    # stage 1
    "labelled": f"SELECT *, string_split(dir, '/')[3] AS folder FROM raw_files "
                f"WHERE contains(file_name, '.txt') AND regexp_matches(text, '{NOT_WS}')",
    "train_dir": "SELECT * FROM labelled WHERE folder = '1.Training'",
    "located": "SELECT doc_id, dir, min(domain) AS domain FROM train_dir JOIN quota ON contains(dir, domain) GROUP BY ALL",
    "listed": """SELECT DISTINCT dir, min(domain) OVER (PARTITION BY dir) AS domain FROM raw_files JOIN quota ON contains(dir, domain)
        WHERE string_split(dir, '/')[3] = '1.Training'""",
    "held": f"""SELECT domain, dir FROM (
        SELECT domain, dir, n_dev, row_number() OVER (PARTITION BY domain ORDER BY md5('{SEED}|' || dir), dir) AS rn
        FROM listed JOIN quota USING (domain)) WHERE rn <= n_dev""",
    # stage 2
    "s": "SELECT line_id AS pos, file, string_split(raw, '::')[2] AS sentence FROM trn_lines WHERE contains(raw, '::')",
    "b": r"SELECT *, regexp_extract_all(sentence, '\([^)\n]*\)') AS br FROM s",
    "f": f"""SELECT *, list_reduce(
        list_prepend(sentence, list_transform(range(1, len(br), 2), lambda i: br[i] || chr(1) || br[i + 1])),
        lambda acc, x: CASE WHEN regexp_matches(split_part(x, chr(1), 1), '{ND}') THEN acc
          ELSE replace(acc, split_part(x, chr(1), 2), split_part(x, chr(1), 1)) END) AS folded FROM b""",
    "judged": rf"""SELECT *, CASE
        WHEN regexp_matches(regexp_replace(sentence, '\([^)]*\)', '', 'g'), '{ND}') THEN 'stray_digit'
        WHEN len(br) = 0 THEN 'no_bracket' WHEN len(br) % 2 = 1 THEN 'odd_brackets'
        WHEN NOT regexp_matches({spell('folded')}, '{ND}') THEN 'no_numeral'
        WHEN ({phon('folded')}) IS NULL OR contains({phon('folded')}, '%') THEN 'bad_phonetic'
        ELSE 'ok' END AS reason FROM f""",
    "valid": f"""SELECT pos, file, {clean(spell('folded'))} AS num_col, {clean(phon('folded'))} AS sen_col
        FROM judged WHERE reason = 'ok'""",
    "pairs": "SELECT num_col, arg_max(sen_col, pos) AS sen_col, min(pos) AS pos FROM valid GROUP BY num_col",
    "split": """SELECT *, CASE WHEN row_number() OVER (ORDER BY pos) <= floor(CAST(count(*) OVER () AS DOUBLE) * CAST(0.1 AS DOUBLE))
        THEN 'valid' ELSE 'train' END AS split FROM pairs""",
    "file_pairs": """SELECT num_col, arg_max(sen_col, (file, pos)) AS sen_col, min((file, pos)) AS first_at FROM valid GROUP BY num_col""",
    # stage 3: Ratcliff-Obershelp as a recursive query over diagonal runs of equal bytes
    "bytes_a": """SELECT pair_id, i, substr(h, CAST(2 * i - 1 AS BIGINT), 2) AS c
        FROM (SELECT pair_id, hex(encode(num_col)) AS h FROM pair_rows) p, unnest(range(1, len(h) // 2 + 1)) u(i)""",
    "bytes_b": """SELECT pair_id, j, c, {autojunk} AND count(*) OVER (PARTITION BY pair_id) >= 200
          AND count(*) OVER (PARTITION BY pair_id, c) > count(*) OVER (PARTITION BY pair_id) // 100 + 1 AS popular
        FROM (SELECT pair_id, j, substr(h, CAST(2 * j - 1 AS BIGINT), 2) AS c
          FROM (SELECT pair_id, hex(encode(sen_col)) AS h FROM pair_rows) p, unnest(range(1, len(h) // 2 + 1)) u(j)) x""",
    "equal": "SELECT pair_id, i, i - j AS d, popular FROM bytes_a JOIN bytes_b USING (pair_id, c)",
    "runs": """SELECT pair_id, d, min(i) AS i0, max(i) + 1 AS i1 FROM (
        SELECT *, i - row_number() OVER (PARTITION BY pair_id, d ORDER BY i) AS g FROM equal) GROUP BY pair_id, d, g""",
    "seeds": """SELECT s.*, r.i0 AS r0, r.i1 AS r1 FROM (
        SELECT pair_id, d, min(i) AS i0, max(i) + 1 AS i1 FROM (
          SELECT *, i - row_number() OVER (PARTITION BY pair_id, d ORDER BY i) AS g FROM equal WHERE NOT popular)
        GROUP BY pair_id, d, g) s
        JOIN runs r ON r.pair_id = s.pair_id AND r.d = s.d AND r.i0 <= s.i0 AND s.i1 <= r.i1""",
    # Without a seed in a region, only equal bytes at its very start form a block.
    "starts": """SELECT *, true AS seed FROM seeds UNION ALL
        SELECT pair_id, d, i0, i1, i0, i1, false FROM runs WHERE pair_id IN (SELECT pair_id FROM bytes_b WHERE popular)""",
    "sizes": "SELECT pair_id, octet_length(encode(num_col)) AS n, octet_length(encode(sen_col)) AS m FROM pair_rows",
    "blocks": """SELECT pair_id, CAST(1 AS BIGINT) AS alo, n + 1 AS ahi, CAST(1 AS BIGINT) AS blo, m + 1 AS bhi, CAST(0 AS BIGINT) AS k FROM sizes
      UNION ALL
      SELECT pair_id, CASE side WHEN 0 THEN alo ELSE e END, CASE side WHEN 0 THEN b ELSE ahi END,
        CASE side WHEN 0 THEN blo ELSE e - d END, CASE side WHEN 0 THEN b - d ELSE bhi END,
        CASE side WHEN 0 THEN e - b ELSE 0 END
      FROM (
        SELECT *, greatest(r0, alo, blo + d) AS b, least(r1, ahi, bhi + d) AS e FROM (
          SELECT *, row_number() OVER (PARTITION BY pair_id, alo, blo ORDER BY e0 - b0 DESC, b0, b0 - d) AS rn FROM (
            SELECT x.pair_id, x.alo, x.ahi, x.blo, x.bhi, s.d, s.r0, s.r1, s.seed,
              CASE WHEN s.seed THEN greatest(s.i0, x.alo, x.blo + s.d) ELSE x.alo END AS b0,
              CASE WHEN s.seed THEN least(s.i1, x.ahi, x.bhi + s.d) ELSE x.alo END AS e0
            FROM blocks x JOIN starts s ON s.pair_id = x.pair_id
            WHERE x.alo < x.ahi AND x.blo < x.bhi
              AND (s.seed OR s.d = x.alo - x.blo AND s.i0 <= x.alo AND x.alo < s.i1)) c
          WHERE e0 > b0 OR NOT seed) r WHERE rn = 1) best, (VALUES (0), (1)) sides(side)""",
    "ratios": """SELECT pair_id, CASE WHEN n + m = 0 THEN 1.0 ELSE 2.0 * sum(k) / (n + m) END AS ratio
        FROM blocks JOIN sizes USING (pair_id) GROUP BY pair_id, n, m""",
    "verdicts": """SELECT p.*, num_col <> '' AND sen_col <> '' OR num_col = sen_col AS sound,
        ratio <= (CASE WHEN length(sen_col) <= 10 THEN 0.1 WHEN length(sen_col) <= 20 THEN 0.2
          WHEN length(sen_col) <= 50 THEN 0.4 ELSE 0.5 END)
        AND right(num_col, 1) <> right(sen_col, 1)
        AND (length(sen_col) > 50 OR regexp_matches(right(num_col, 1), '[가-힣]')) AS bad
        FROM pair_rows p JOIN ratios USING (pair_id)""",
    "kept": "SELECT pair_id, num_col, sen_col FROM verdicts WHERE sound AND NOT bad",
    "doc_kept": """SELECT pair_id, num_col, sen_col FROM doc_pair_rows
        WHERE num_col = '' AND sen_col = '' OR num_col <> '' AND sen_col <> '' AND right(num_col, 1) = right(sen_col, 1)""",
    # stage 4
    "vocab_pairs": f"""SELECT token, count(*) AS n FROM (SELECT unnest({words('num_col')}) AS token FROM pairs
        UNION ALL SELECT unnest({words('sen_col')}) FROM pairs) GROUP BY token""",
    "vocab": """SELECT 4 + row_number() OVER (ORDER BY n DESC, token) AS id, token, n FROM vocab_pairs""",
    "by_length": f"""SELECT doc_id, length, row_number() OVER (ORDER BY length, doc_id) - 1 AS place
        FROM (SELECT doc_id, len({words('text')}) AS length FROM documents)""",
    # each batch ends at the last row up to which the rows, padded, stay within the budget
    "cuts": """SELECT CAST(0 AS BIGINT) AS batch, CAST(-1 AS BIGINT) AS before, (SELECT max(place) FROM by_length WHERE (place + 1) * length <= 20000) AS last
      UNION ALL
      SELECT batch + 1, last, coalesce((SELECT max(place) FROM by_length l WHERE place > last AND (place - last) * length <= 20000), last + 1)
      FROM cuts WHERE last < (SELECT max(place) FROM by_length)""",
    "batched": "SELECT doc_id, length, batch, place FROM by_length JOIN cuts ON place > before AND place <= last",
    # stage 5
    "ids": "SELECT vec_id, list_transform(embedding, lambda x, i: CASE WHEN (i - 1) % 4 = 3 THEN -100 "
           "ELSE CAST(floor(abs(CAST(x AS DOUBLE)) * 1000) AS INTEGER) END) AS ids FROM embeddings",
    "scored": "SELECT conv_id * 1000 + turn AS row_id, conv_id, turn, pred, ref FROM pred_ref",
    "tok13": f"""SELECT row_id, 'p' AS side, unnest(ws) AS w, generate_subscripts(ws, 1) AS i FROM (SELECT row_id, {words_13a('pred')} AS ws FROM scored)
        UNION ALL SELECT row_id, 'r', unnest(ws), generate_subscripts(ws, 1) FROM (SELECT row_id, {words_13a('ref')} AS ws FROM scored)""",
    "tok": f"""SELECT row_id, 'p' AS side, unnest(ws) AS w, generate_subscripts(ws, 1) AS i FROM (SELECT row_id, {words('pred')} AS ws FROM scored)
        UNION ALL SELECT row_id, 'r', unnest(ws), generate_subscripts(ws, 1) FROM (SELECT row_id, {words('ref')} AS ws FROM scored)""",
}


def _grams(source: str, orders: int) -> str:
    """n-grams of every order by looking ahead in the token table."""
    ahead = ", ".join(
        f"lead(w, {k}) OVER (PARTITION BY row_id, side ORDER BY i) AS w{k}" for k in range(1, orders)
    )
    parts = []
    for n in range(1, orders + 1):
        gram = " || ' ' || ".join(["w", *[f"w{k}" for k in range(1, n)]])
        parts.append(f"SELECT row_id, side, {n} AS o, {gram} AS g FROM a WHERE ({gram}) IS NOT NULL")
    return f"WITH a AS (SELECT *, {ahead} FROM {source}) " + " UNION ALL ".join(parts)


CTES["gram13"] = _grams("tok13", 4)
CTES["gram"] = _grams("tok", 2)
for _src, _out in (("gram13", "count13"), ("gram", "counts")):
    CTES[_out] = f"""SELECT row_id, o, g, count(*) FILTER (side = 'p') AS p, count(*) FILTER (side = 'r') AS r
        FROM {_src} GROUP BY row_id, o, g"""
CTES |= {
    "by_order": "SELECT o, sum(least(p, r)) AS m, sum(p) AS p, sum(r) AS r FROM count13 GROUP BY o",
    "lens": "SELECT max(p) FILTER (o = 1) AS c, max(r) FILTER (o = 1) AS r, count(*) FILTER (m > 0) AS orders, "
            "exp(sum(CASE WHEN m > 0 THEN ln(CAST(m AS DOUBLE) / p) END) / 4) AS geo FROM by_order",
    "bleu": """SELECT CASE WHEN orders = 4 THEN geo ELSE 0.0 END * bp AS bleu, bp AS brevity_penalty, c / r AS length_ratio,
        CAST(c AS BIGINT) AS translation_length, CAST(r AS BIGINT) AS reference_length
        FROM (SELECT *, CASE WHEN c > r THEN 1.0 ELSE exp(1 - CAST(r AS DOUBLE) / c) END AS bp FROM lens)""",
    "rouge_rows": """SELECT row_id, conv_id, turn, coalesce(max(f) FILTER (o = 1), 0) AS rouge1, coalesce(max(f) FILTER (o = 2), 0) AS rouge2
        FROM scored LEFT JOIN (SELECT row_id, o, 2.0 * sum(least(p, r)) / sum(p + r) AS f FROM counts GROUP BY row_id, o) USING (row_id)
        GROUP BY row_id, conv_id, turn""",
    # longest common subsequence: t[k] is the least end position of a common subsequence of length k
    "places": """SELECT r.row_id, CAST(r.i AS BIGINT) AS i, list(p.i ORDER BY p.i) AS ps FROM tok r
        JOIN tok p ON p.row_id = r.row_id AND p.side = 'p' AND p.w = r.w WHERE r.side = 'r' GROUP BY r.row_id, r.i""",
    "seq": "SELECT row_id, ps, row_number() OVER (PARTITION BY row_id ORDER BY i) AS step FROM places",
    "lcs": """SELECT row_id, CAST(0 AS BIGINT) AS step, CAST([] AS BIGINT[]) AS t FROM scored
      UNION ALL
      SELECT row_id, step, list_filter(list_transform(range(1, len(t) + 2), lambda k:
          least(t[k], list_min(list_filter(ps, lambda p: p > CASE WHEN k = 1 THEN 0 ELSE t[k - 1] END)))), lambda v: v IS NOT NULL)
      FROM (SELECT l.row_id, s.step, l.t, s.ps FROM lcs l JOIN seq s ON s.row_id = l.row_id AND s.step = l.step + 1) x""",
    "rouge_l": """SELECT row_id, conv_id, turn, coalesce(2.0 * l / nullif(n, 0), 0) AS rougeL FROM scored
        JOIN (SELECT row_id, max(len(t)) AS l FROM lcs GROUP BY row_id) USING (row_id)
        LEFT JOIN (SELECT row_id, count(*) AS n FROM tok GROUP BY row_id) USING (row_id)""",
    # lexicon
    "duals": f"""SELECT pos, regexp_split_to_array(sentence, '{DUAL}') AS around,
        regexp_extract_all(sentence, '{DUAL}', 1) AS nums, regexp_extract_all(sentence, '{DUAL}', 2) AS reads FROM s""",
    "dual": "SELECT around[k] AS bef, around[k + 1] AS aft, nums[k] AS num, reads[k] AS reading "
            "FROM duals, unnest(range(1, len(nums) + 1)) u(k)",
    "dual_text": f"""SELECT regexp_extract(bef, '({NOT_WS}*)$', 1) || num || regexp_extract(aft, '^({NOT_WS}*)', 1) AS num,
        regexp_extract(bef, '({NOT_WS}*)$', 1) || reading || regexp_extract(aft, '^({NOT_WS}*)', 1) AS reading,
        regexp_extract(aft, '^{NOT_WS}*{WS}+({NOT_WS}+)', 1) AS nxt FROM dual""",
    "readings": f"""SELECT * FROM (SELECT {clean('num')} AS num, CASE WHEN NOT contains(reading, '%') THEN {clean('reading')} END AS reading,
        {clean('nxt')} AS next_token FROM dual_text) WHERE regexp_matches(num, '{ND}') AND length(reading) > 0""",
}
for _name, _src, _dst in (("lex", "num", "reading"), ("lex_back", "reading", "num")):
    CTES[_name] = f"""SELECT src, next_token, dst, n FROM (
        SELECT *, row_number() OVER (PARTITION BY src, next_token ORDER BY n DESC, dst) AS rn FROM (
          SELECT {_src} AS src, next_token, {_dst} AS dst, count(*) AS n FROM readings WHERE next_token <> '' GROUP BY ALL
          UNION ALL SELECT {_src}, NULL, {_dst}, count(*) FROM readings GROUP BY ALL)) WHERE rn = 1"""
for _name, _lex, _col in (("fwd", "lex", "num_col"), ("bwd", "lex_back", "sen_col")):
    CTES |= {
        f"{_name}_text": f"SELECT pos, {words(_col)} AS ws FROM pairs",
        f"{_name}_cand": f"""SELECT pos, place, width, array_to_string(ws[place:place + width - 1], ' ') AS phrase, ws[place + width] AS nxt
            FROM {_name}_text, unnest(range(1, len(ws) + 1)) u(place),
              (SELECT DISTINCT len({words('src')}) AS width FROM {_lex}) w WHERE place + width - 1 <= len(ws)""",
        f"{_name}_hit": f"""SELECT pos, place, max(width) AS width, arg_max(coalesce(c.dst, a.dst), width) AS dst FROM {_name}_cand
            JOIN {_lex} a ON a.src = phrase AND a.next_token IS NULL
            LEFT JOIN {_lex} c ON c.src = phrase AND c.next_token = nxt GROUP BY pos, place""",
        f"{_name}_walk": f"""SELECT pos, CAST(1 AS BIGINT) AS place, CAST([] AS VARCHAR[]) AS made FROM {_name}_text
          UNION ALL
          SELECT w.pos, w.place + coalesce(h.width, 1), list_append(made, coalesce(h.dst, ws[w.place]))
          FROM {_name}_walk w JOIN {_name}_text t ON t.pos = w.pos
          LEFT JOIN {_name}_hit h ON h.pos = w.pos AND h.place = w.place WHERE w.place <= len(ws)""",
        f"{_name}_done": f"""SELECT pos, array_to_string(arg_max(made, place), ' ') AS converted FROM {_name}_walk GROUP BY pos""",
    }


def _with(sql: str, **changes: str) -> str:
    """``sql`` preceded by the sub-queries it mentions, directly or not."""
    texts = CTES | changes
    order: list[str] = []

    def visit(text: str, inside: str = "") -> None:
        mentioned = re.findall(r"\b(?:FROM|JOIN) (\w+)", text)
        for name in dict.fromkeys(mentioned):
            if name in texts and name != inside and name not in order:
                visit(texts[name], name)
                order.append(name)

    visit(sql)
    body = ",\n".join(f"{n} AS ({texts[n].replace('{autojunk}', 'true')})" for n in order)
    return f"WITH RECURSIVE {body}\n{sql}" if order else sql


def _profile(source: str, series: dict[str, str], digits: int, within: str = "") -> str:
    head = f"{within}, " if within else ""
    rows = " UNION ALL ".join(
        f"SELECT {head}'{name}' AS series, length({col}) AS v FROM {source}" for name, col in series.items()
    )
    keys = f"{head}series"

    def r(x: str, name: str) -> str:
        return f"round(CAST({x} AS DOUBLE), {digits}) AS {name}"

    return f"""SELECT {keys}, count(*) AS n, {r('avg(v)', 'mean')}, {r('median(v)', 'median')},
        CAST(max(top) AS BIGINT) AS mode, CAST(max(v) AS BIGINT) AS max, CAST(min(v) AS BIGINT) AS min,
        {r('stddev_samp(v)', 'std_samp')}, {r('stddev_pop(v)', 'std_pop')}, {r('var_samp(v)', 'var_samp')}, {r('var_pop(v)', 'var_pop')},
        {r('quantile_cont(v, 0.75) - quantile_cont(v, 0.25)', 'iqr')}, CAST(max(v) - min(v) AS BIGINT) AS range
        FROM ({rows}) JOIN (SELECT {keys}, v AS top FROM (SELECT {keys}, v, row_number() OVER (PARTITION BY {keys} ORDER BY count(*) DESC, v) AS rn
          FROM ({rows}) GROUP BY {keys}, v) WHERE rn = 1) USING ({keys}) GROUP BY {keys}"""


_SIDES = {"sen": "sen_col", "num": "num_col"}
_BLEU = "round(bleu, 6) AS bleu, round(brevity_penalty, 6) AS brevity_penalty, round(length_ratio, 6) AS length_ratio, translation_length, reference_length"
_ALL = """SELECT (SELECT round(avg(rouge1), 6) FROM rouge_rows) AS rouge1, (SELECT round(avg(rouge2), 6) FROM rouge_rows) AS rouge2,
    (SELECT round(avg(rougeL), 6) FROM rouge_l) AS "rougeL", (SELECT round(avg(rougeL), 6) FROM rouge_l) AS "rougeLsum",
    round(bleu, 6) AS bleu, round(brevity_penalty, 6) AS brevity_penalty, round(length_ratio, 6) AS length_ratio,
    CAST(translation_length AS DOUBLE) AS translation_length, CAST(reference_length AS DOUBLE) AS reference_length,
    (SELECT CAST(count(*) AS DOUBLE) FROM scored) AS predict_samples FROM bleu"""
_SPECIALS = "SELECT * FROM (VALUES (0, '<s>', 0), (1, '</s>', 0), (2, '<unk>', 0), (3, '<pad>', 0), (4, '<mask>', 0)) x(id, token, n)"


def _ids_of(ws: str, tail: str = "", cut: str = "") -> str:
    """Space-joined ids of a word list per pair position."""
    return f"""SELECT pos, array_to_string(list_concat(list(coalesce(id, 2) ORDER BY i){cut}, {tail or '[]'}), ' ') AS ids, count(*) AS n
        FROM (SELECT pos, unnest({ws}) AS token, generate_subscripts({ws}, 1) AS i FROM pairs) LEFT JOIN vocab USING (token) GROUP BY pos"""


_MAPPED = {
    "trn_sentences": "SELECT pos, sentence FROM s",
    "bracket_spelling": f"SELECT pos, {spell('sentence')} AS kept FROM s",
    "bracket_phonetic": f"SELECT pos, {phon('sentence')} AS kept FROM s",
    "special_filter_spelling": f"SELECT pos, {clean('sentence')} AS cleaned FROM s",
    "special_filter_phonetic": f"""SELECT pos, CASE WHEN NOT contains(sentence, '%') THEN {clean('sentence')} END AS strict,
        {squeezed(f"replace({plain('sentence')}, '%', ' 퍼센트')")} AS read FROM s""",
    "special_filter_docs": f"SELECT doc_id, {clean('text')} AS cleaned FROM documents",
    "sentence_filter_spelling": f"SELECT pos, {clean(spell('sentence'))} AS cleaned FROM s",
    "bracket_pairs": "SELECT pos, k AS i, br[2 * k + 1] AS first, br[2 * k + 2] AS second FROM b, unnest(range(0, len(br) // 2)) u(k)",
    "reading_fold": "SELECT pos, folded FROM f",
    "whitespace_tokens": f"""SELECT doc_id, len({words('text')}) AS n_tokens, md5(array_to_string({words('text')}, '|')) AS digest FROM documents""",
    "text_sizes": """SELECT pair_id, length(sen_col) AS n_chars, octet_length(encode(sen_col)) AS n_bytes, hex(encode(sen_col)) AS bytes_hex,
        right(sen_col, 1) AS last_char, regexp_matches(right(sen_col, 1), '[가-힣]') AS last_hangul FROM pair_rows""",
    "path_parts": "SELECT doc_id, dir, file_name FROM raw_files",
    "vendor_gate": """SELECT scenario, vendor, n_files, vendor IN ('티맥스소프트', '솔루게이트') AS accepted,
        CASE WHEN vendor NOT IN ('티맥스소프트', '솔루게이트') THEN 'vendor not supported: ' || vendor END AS reason FROM scenarios""",
    "tree_dirs": """SELECT DISTINCT dir FROM raw_files WHERE left(string_split(dir, '/')[4], 4) IN ('src0', 'src1', 'src2', 'src3', 'src4')
        AND string_split(dir, '/')[6] NOT IN ('S0', 'S1', 'S2')""",
    "raw_nonblank": "SELECT doc_id, dir, file_name FROM train_dir",
    "script_dedup": "SELECT DISTINCT text FROM train_dir",
    "eval_scripts": "SELECT DISTINCT text FROM labelled WHERE folder = '2.Validation'",
    "script_counts": "SELECT folder, count(*) AS n_total, count(DISTINCT text) AS n_unique FROM labelled GROUP BY folder",
    "domain_paths": "SELECT * FROM located",
    **{name: f"""SELECT domain, CAST(list_no AS BIGINT) AS list_no, string_agg(dir, ' ' ORDER BY dir) AS dirs FROM (
        SELECT domain, dir, ('0x' || substr(md5(dir), 1, 8))::UBIGINT % CAST(ceil(count(*) OVER (PARTITION BY domain) / {size}) AS UBIGINT) AS list_no
        FROM listed) GROUP BY domain, list_no"""
       for name, size in (("domain_dir_lists", 1000.0), ("domain_dir_lists_small", 4.0))},
    "dev_holdout": "SELECT domain, dir FROM held",
    "quota_shortage": """SELECT domain, CAST(any_value(n_dev) AS BIGINT) AS n_dev, count(dir) AS n_found FROM quota LEFT JOIN held USING (domain)
        GROUP BY domain HAVING count(dir) < any_value(n_dev)""",
    "train_scripts": "SELECT DISTINCT text FROM train_dir WHERE dir NOT IN (SELECT dir FROM held)",
    "dev_scripts": "SELECT DISTINCT text FROM train_dir WHERE dir IN (SELECT dir FROM held)",
    "split_script_counts": """SELECT CASE WHEN dir IN (SELECT dir FROM held) THEN 'dev' ELSE 'train' END AS split,
        count(*) AS n_total, count(DISTINCT text) AS n_unique FROM train_dir GROUP BY 1""",
    "stage2_valid": "SELECT pos, num_col, sen_col FROM valid",
    "stage2_outcomes": "SELECT pos, reason FROM judged",
    "sentence_pairs": "SELECT num_col, sen_col, pos FROM pairs",
    "pair_split": "SELECT num_col, sen_col, pos, split FROM split",
    "pair_hash_split": f"""SELECT *, CASE WHEN ('0x' || substr(md5('{SEED}|' || num_col), 1, 8))::UBIGINT / 4294967296.0::DOUBLE < 0.1::DOUBLE
        THEN 'valid' ELSE 'train' END AS split FROM pairs""",
    "split_sizes": "SELECT split, count(*) AS n FROM split GROUP BY split",
    "pair_csv_round_trip": "SELECT num_col, sen_col FROM pairs",
    "trn_file_pairs": "SELECT num_col, sen_col FROM file_pairs",
    "trn_file_split": """SELECT num_col, sen_col, CASE WHEN row_number() OVER (ORDER BY first_at) <= floor(CAST(count(*) OVER () AS DOUBLE) * CAST(0.1 AS DOUBLE))
        THEN 'valid' ELSE 'train' END AS split FROM file_pairs""",
    "pair_native_keep": """SELECT * FROM (SELECT pair_id, num_col, sen_col, CASE WHEN num_col = '' AND sen_col = '' THEN 'keep'
        WHEN num_col = '' OR sen_col = '' THEN 'quarantine'
        WHEN right(num_col, 1) = right(sen_col, 1) THEN 'keep'
        WHEN length(sen_col) <= 50 AND NOT regexp_matches(right(num_col, 1), '[가-힣]') THEN 'keep'
        WHEN 2.0 * least(n, m) / (n + m) <= (CASE WHEN length(sen_col) <= 10 THEN 0.1 WHEN length(sen_col) <= 20 THEN 0.2
          WHEN length(sen_col) <= 50 THEN 0.4 ELSE 0.5 END) THEN 'drop' END AS verdict
        FROM pair_rows JOIN sizes USING (pair_id)) x WHERE verdict IS NOT NULL""",
    "pair_filter": "SELECT pair_id, num_col, sen_col FROM kept",
    "text_sizes_docs": """SELECT pair_id, length(num_col) AS num_chars, octet_length(encode(num_col)) AS num_bytes, length(sen_col) AS n_chars,
        octet_length(encode(sen_col)) AS n_bytes, hex(encode(sen_col)) AS bytes_hex, right(sen_col, 1) AS last_char,
        regexp_matches(right(sen_col, 1), '[가-힣]') AS last_hangul FROM doc_pair_rows""",
    "length_eda_before_docs": _profile("doc_pair_rows", _SIDES, 4),
    "length_eda_after_docs": _profile("doc_kept", _SIDES, 4),
    "csv_union_docs": """SELECT pair_id, -1 AS pos, num_col, sen_col FROM doc_pair_rows
        UNION ALL SELECT -1, pos, num_col, sen_col FROM pairs""",
    "length_eda_before": _profile("pair_rows", _SIDES, 4),
    "length_eda_after": _profile("kept", _SIDES, 4),
    "doc_length_eda": _profile("documents", {"text": "text"}, 3, "lang"),
    "examples_ntt": "SELECT pos, num_col AS input, sen_col AS label FROM pairs",
    "examples_ttn": "SELECT pos, sen_col AS input, num_col AS label FROM pairs",
    "examples_prompt": "SELECT pos, 'translation_num_to_txt: ' || num_col AS input, sen_col AS label FROM pairs",
    "examples_causal": """SELECT pos, t AS input, t AS label FROM (SELECT pos, '<s>' || sen_col || '</s><s>' || num_col || '</s>' AS t FROM pairs)""",
    "mapped_examples": "SELECT pos, nfc_normalize(num_col) AS input, nfc_normalize(sen_col) AS label FROM pairs",
    "examples_causal_ids": f"""SELECT pos, t AS input_ids, t AS labels, len(string_split(t, ' ')) AS length FROM (
        SELECT pos, '0 ' || a.ids || ' 1 0 ' || b.ids || ' 1' AS t FROM ({_ids_of(words('sen_col'))}) a JOIN ({_ids_of(words('num_col'))}) b USING (pos))""",
    "token_batches": "SELECT doc_id, length, batch, place FROM batched",
    "token_batch_padding": """SELECT count(*) AS batches, CAST(sum(n) AS BIGINT) AS rows, CAST(sum(tokens) AS BIGINT) AS tokens,
        CAST(sum(padded) AS BIGINT) AS padded, round(1 - CAST(sum(tokens) AS DOUBLE) / sum(padded), 6) AS padding_share
        FROM (SELECT batch, count(*) AS n, sum(length) AS tokens, count(*) * max(length) AS padded FROM batched GROUP BY batch)""",
    "csv_union": """SELECT pair_id, -1 AS pos, num_col, sen_col FROM pair_rows
        UNION ALL SELECT -1, pos, num_col, sen_col FROM pairs""",
    "vocabulary_ids": f"SELECT id, token, n FROM vocab UNION ALL {_SPECIALS}",
    "vocabulary_docs": f"""SELECT 4 + row_number() OVER (ORDER BY n DESC, token) AS id, token, n FROM (
        SELECT token, count(*) AS n FROM (SELECT unnest({words('text')}) AS token FROM documents)
        GROUP BY token) UNION ALL {_SPECIALS}""",
    "encode_ids": f"""SELECT pos, a.ids AS input_ids, b.ids AS labels, a.n AS length FROM ({_ids_of(words('num_col'))}) a
        JOIN ({_ids_of(words('sen_col'), '[1]')}) b USING (pos)""",
    **{name: f"""SELECT pos, a.ids AS input_ids, b.ids AS labels
        FROM ({_ids_of("list_prepend('translation_num_to_txt:', " + words('num_col') + ")", cut=cut)}) a
        JOIN ({_ids_of(words('sen_col'), '[1]', cut)}) b USING (pos)"""
       for name, cut in (("encode_prompts", ""), ("encode_prompts_cut", "[1:2]"))},
    "decode_ids": f"SELECT pos, array_to_string({words('sen_col')}, ' ') AS text FROM pairs",
    "encode_docs": f"""SELECT doc_id, md5(string_agg(CAST(id AS VARCHAR), ' ' ORDER BY i)) AS digest, count(*) AS n_ids
        FROM (SELECT doc_id, unnest(ws) AS token, generate_subscripts(ws, 1) AS i FROM (SELECT doc_id, {words('text')} AS ws FROM documents))
        JOIN (SELECT 4 + row_number() OVER (ORDER BY n DESC, token) AS id, token FROM (
          SELECT token, count(*) AS n FROM (SELECT unnest({words('text')}) AS token FROM documents) GROUP BY token)) USING (token)
        GROUP BY doc_id""",
    "length_buckets": f"""SELECT doc_id, length, len(list_filter(edges, lambda e: e < length)) AS bucket
        FROM (SELECT doc_id, len({words('text')}) AS length FROM documents),
          (SELECT quantile_cont(len({words('text')}), [0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9]) AS edges FROM documents)""",
    "materialised_examples": "SELECT pos, num_col AS input, sen_col AS label FROM pairs",
    "masked_ids": "SELECT vec_id, array_to_string(list_transform(ids, lambda x: CASE WHEN x = -100 THEN 3 ELSE x END), ' ') AS ids FROM ids",
    "argmax_ids": "SELECT vec_id, CAST(list_position(embedding, list_max(embedding)) - 1 AS BIGINT) AS best FROM embeddings",
    "argmax_rows": """SELECT vec_id, array_to_string(list_transform(range(0, 4), lambda k:
        list_position(embedding[k * q + 1:CASE k WHEN 3 THEN len(embedding) ELSE k * q + q END],
          list_max(embedding[k * q + 1:CASE k WHEN 3 THEN len(embedding) ELSE k * q + q END])) - 1), ' ') AS best
        FROM (SELECT vec_id, embedding, len(embedding) // 4 AS q FROM embeddings)""",
    "array_edits": """SELECT vec_id, array_to_string(list_append(ids[1:5], 1), ' ') AS ended, array_to_string(ids[1:3][:-2], ' ') AS shorter,
        len(ids) AS n_ids FROM ids""",
    "tokens_13a_refs": f"SELECT conv_id, turn, array_to_string({words_13a('ref')}, ' ') AS tokens FROM pred_ref",
    "corpus_bleu": f"SELECT {_BLEU} FROM bleu",
    "rouge_n": "SELECT round(avg(rouge1), 6) AS rouge1, round(avg(rouge2), 6) AS rouge2 FROM rouge_rows",
    "rouge_n_rows": "SELECT conv_id, turn, round(rouge1, 6) AS rouge1, round(rouge2, 6) AS rouge2 FROM rouge_rows",
    "rouge_l_rows": 'SELECT conv_id, turn, round(rougeL, 6) AS "rougeL" FROM rouge_l',
    "evaluate_all": _ALL,
    "dual_readings": "SELECT num, reading, next_token, count(*) AS n FROM readings GROUP BY ALL",
    "reading_lexicon": "SELECT * FROM lex",
    "spelling_lexicon": "SELECT * FROM lex_back",
    "lexicon_convert": "SELECT pos, num_col, converted FROM pairs JOIN fwd_done USING (pos)",
    "lexicon_convert_back": "SELECT pos, sen_col, converted FROM pairs JOIN bwd_done USING (pos)",
    "stream_ingest": "SELECT num_col, sen_col FROM valid",
    "stream_dedup": "SELECT num_col, sen_col FROM file_pairs",
}

ORACLES = {name: _with(sql) for name, sql in _MAPPED.items()}
# Words of predictions and references survive the id round trip, reserved ids do not.
ORACLES["decoded_bleu"] = _with(
    f"SELECT {_BLEU} FROM bleu",
    scored=f"""SELECT conv_id * 1000 + turn AS row_id, conv_id, turn, array_to_string({words('pred')}, ' ') AS pred,
        array_to_string({words('ref')}, ' ') AS ref FROM pred_ref""",
)
# Learned outside the valid split, wherever its pairs stand, scored on it.
_VALID = "SELECT pos FROM split WHERE split = 'valid'"
_KNOWN = "SELECT pos FROM valid WHERE num_col IN (SELECT num_col FROM split WHERE split = 'valid')"
ORACLES["lexicon_eval"] = _with(
    _ALL,
    duals=f"{CTES['duals']} WHERE pos NOT IN ({_KNOWN})",
    scored=f"""SELECT pos AS row_id, 0 AS conv_id, pos AS turn, converted AS pred, sen_col AS ref
        FROM pairs JOIN fwd_done USING (pos) WHERE pos IN ({_VALID})""",
)
