"""DuckDB SQL with the results of the queries, written apart from them."""

from __future__ import annotations

from . import queries as q
from . import samples

def two(x: str) -> str:
    return f"CASE WHEN {x} < 10 THEN '0' ELSE '' END || cast({x} as string)"


def mean(x: str) -> str:
    """Of numbers of up to 8 digits after the point: in whole numbers, 4 digits, ties to even."""
    total, n = f"sum(cast(cast({x} AS decimal(18, 8)) * 100000000 AS bigint))", f"(count({x}) * 10000)"
    q, r = f"({total} // {n})", f"({total} % {n})"
    return f"CASE WHEN count({x}) > 0 THEN ({q} + CASE WHEN 2 * {r} > {n} OR 2 * {r} = {n} AND {q} % 2 = 1 THEN 1 ELSE 0 END)::DOUBLE / 10000 END"


def strict(src: str, raw: str, out: str) -> str:
    shape = r"^([0-2]?\d):([0-5]\d)(am|pm)?$"
    return rf"""SELECT * EXCLUDE (s_t, s_h0, s_h, s_a) FROM (SELECT *,
      regexp_replace(translate(regexp_replace(lower({raw}), '([ap])\.m\.?', '\1m', 'g'), ';,.-', '::::'), '\s+', '', 'g') AS s_t,
      try_cast(nullif(regexp_extract(s_t, '{shape}', 1), '') AS int) AS s_h0, regexp_extract(s_t, '{shape}', 3) AS s_a,
      CASE WHEN s_a = 'am' AND s_h0 = 12 THEN 0 WHEN s_a = 'pm' AND s_h0 < 12 THEN s_h0 + 12 ELSE s_h0 END AS s_h,
      CASE WHEN s_h <= 23 THEN {two('s_h')} || ':' || regexp_extract(s_t, '{shape}', 2) END AS {out} FROM ({src}))"""


def lenient(src: str, raw: str, out: str) -> str:
    shape, plain = r"^[^0-9]*([0-9]{1,3}):([0-9]{2})[^0-9]*$", r"^\s*(\d{1,2})[:hH]?(\d{2})\s*([aApP][mM])?\s*$"
    hour = lambda h, a: f"CASE WHEN {a} = 'am' AND {h} = 12 THEN 0 WHEN {a} = 'pm' AND {h} < 12 THEN {h} + 12 ELSE {h} END"
    good = lambda h, m: f"CASE WHEN {h} BETWEEN 0 AND 23 AND try_cast(nullif({m}, '') AS int) <= 59 THEN {two(h)} || ':' || {m} END"
    return rf"""SELECT * EXCLUDE (n_a, n_t, n_d, n_c, n_l, n_u, n_h0, n_m, n_h, n_p0, n_p, n_q) FROM (SELECT *,
      lower(replace(regexp_extract({raw}, '([aApP] *[mM])', 1), ' ', '')) AS n_a,
      regexp_replace(translate(trim({raw}), '.-/hH', ':::::'), '[^0-9:apmAPM]', '', 'g') AS n_t,
      regexp_replace(n_t, '[^0-9]', '', 'g') AS n_d, length(n_t) - length(replace(n_t, ':', '')) AS n_c,
      regexp_replace(split_part(n_t, ':', 1), '[^0-9]', '', 'g') AS n_l,
      CASE WHEN n_c > 1 THEN n_l || ':' || substr(n_d, length(n_l) + 1)
           WHEN n_c = 0 THEN CASE WHEN length(n_d) >= 3 THEN substr(n_d, 1, length(n_d) - 2) || ':' || right(n_d, 2) END ELSE n_t END AS n_u,
      try_cast(nullif(regexp_replace(regexp_extract(n_u, '{shape}', 1), '^1([0-9][0-9])$', '\1'), '') AS int) AS n_h0,
      regexp_extract(n_u, '{shape}', 2) AS n_m, {hour('n_h0', 'n_a')} AS n_h,
      try_cast(nullif(regexp_extract({raw}, '{plain}', 1), '') AS int) AS n_p0, lower(regexp_extract({raw}, '{plain}', 3)) AS n_q,
      {hour('n_p0', 'n_q')} AS n_p,
      coalesce({good('n_h', 'n_m')}, {good('n_p', f"regexp_extract({raw}, '{plain}', 2)")}) AS {out} FROM ({src}))"""


def cleaned(src: str, raw: str, out: str) -> str:
    between = lambda x: rf"regexp_replace({x}, '([0-9])[./\\]([0-9])', '\1:\2', 'g')"
    return rf"""SELECT * EXCLUDE (c_a, c_b, c_c, c_d) FROM (SELECT *,
      translate({between(between(f"translate(trim({raw}), 'OoS', '005')"))}, ',', ':') AS c_a,
      trim(regexp_replace(regexp_replace(c_a, '[^0-9apmAPM:]', '', 'g'), ':+', ':', 'g'), ':') AS c_b,
      regexp_replace(c_b, '^([^:]*):.*:([^:]*)$', '\1:\2') AS c_c,
      regexp_replace(c_c, '^([0-9][0-9]?):[0-9]*([0-9][0-9])$', '\1:\2') AS c_d,
      CASE WHEN regexp_full_match(c_d, '[0-9]{{3}}') THEN left(c_d, 1) || ':' || right(c_d, 2)
           WHEN regexp_full_match(c_d, '[0-9]{{4,5}}') THEN left(c_d, 2) || ':' || right(c_d, 2) ELSE c_d END AS {out} FROM ({src}))"""


def parsed(src: str, raw: str, out: str, notes: str) -> str:
    shape = r"^([0-9]{1,2})(?:[:.\- ]([0-9]{1,2}))?(am|pm|a|p|AM|PM|A|P)?$"
    return rf"""SELECT * EXCLUDE (p_t, p_h, p_m, p_a, p_d) FROM (SELECT *,
      try_cast(nullif(regexp_extract(p_t, '{shape}', 1), '') AS int) AS p_h,
      coalesce(try_cast(nullif(regexp_extract(p_t, '{shape}', 2), '') AS int), 0) AS p_m,
      lower(left(regexp_extract(p_t, '{shape}', 3), 1)) AS p_a,
      CASE p_a WHEN 'a' THEN CASE WHEN p_h = 12 THEN 0 ELSE p_h END WHEN 'p' THEN CASE WHEN p_h = 12 THEN 12 ELSE p_h + 12 END ELSE p_h % 24 END AS p_d,
      {two('p_d')} || ':' || lpad(cast(least(p_m, 59) AS string), 2, '0') AS {out},
      CASE WHEN {raw} IS NULL THEN ['empty'] WHEN p_h IS NULL THEN ['unparsable(''' || {raw} || ''')']
           ELSE list_filter([CASE WHEN p_m > 59 THEN 'minutes>59' END, CASE WHEN p_a = '' AND p_h > 23 THEN 'hour>23' END], lambda x: x IS NOT NULL) END AS {notes}
      FROM ({cleaned(src, raw, 'p_t')}))"""


def amount(src: str, raw: str, out: str) -> str:
    return rf"""SELECT * EXCLUDE (a_1, a_2, a_3, a_4, a_5, a_6, a_v) FROM (SELECT *,
      ltrim(replace(replace(regexp_replace(translate(trim({raw}), 'Oo', '00'), '[^0-9().,$-]', '', 'g'), ',,', ','), '..', '.'), '$') AS a_1,
      CASE WHEN contains(a_1, '.') THEN replace(a_1, ',', '') WHEN regexp_matches(a_1, ',[0-9][0-9]\)?$') THEN replace(a_1, ',', '.') ELSE a_1 END AS a_2,
      replace(regexp_replace(a_2, '[.,]$', ''), ',', '') AS a_3, trim(a_3, '()') AS a_4,
      a_3 LIKE '(%' OR a_3 LIKE '%)' OR a_4 LIKE '-%' AS a_5, ltrim(a_4, '-') AS a_6,
      CASE WHEN regexp_full_match(a_6, '[0-9]+\.?[0-9]*|\.[0-9]+') THEN try_cast(a_6 AS decimal(38, 10)) END AS a_v,
      CASE WHEN a_5 AND a_v <> 0 THEN '-' ELSE '' END || cast(cast(round_even(a_v, 2) AS decimal(30, 2)) AS string) AS {out} FROM ({src}))"""


def day(src: str, raw: str, out: str) -> str:
    shape = r"^([0-9]{1,2})/([0-9]{1,2})/([0-9]{2,4})$"
    part = lambda i: f"try_cast(nullif(regexp_extract(d_t, '{shape}', {i}), '') AS int)"
    return f"""SELECT * EXCLUDE (d_t, d_m, d_d, d_0, d_y) FROM (SELECT *, translate(trim({raw}), '-.', '//') AS d_t, {part(1)} AS d_m, {part(2)} AS d_d, {part(3)} AS d_0,
      CASE WHEN d_0 < 100 THEN d_0 + 2000 ELSE d_0 END AS d_y,
      CASE WHEN d_m BETWEEN 1 AND 12 AND d_d BETWEEN 1 AND 31 AND d_y BETWEEN 2000 AND 2100 THEN {two('d_m')} || '/' || {two('d_d')} || '/' || cast(d_y AS string) END AS {out} FROM ({src}))"""


def lines(**made: str) -> str:
    return "SELECT l_orderkey, l_linenumber, " + ", ".join(f"{e} AS {n}" for n, e in made.items()) + " FROM lineitem"


_EXPORT = parsed(
    f"SELECT l_orderkey, l_linenumber, CASE WHEN l_partkey % 50 = 0 THEN NULL ELSE {samples.TIME} END AS RawText, CASE WHEN l_orderkey % 500 = 7 THEN NULL ELSE l_orderkey % 500 END AS TimesheetID, CASE WHEN l_suppkey % 40 = 0 THEN NULL ELSE round(l_discount * 10, 2) END AS Confidence FROM lineitem",
    "RawText", "NormalizedTime", "w",
)
_EXPORT = f"""SELECT *, list_concat(w, list_filter([CASE WHEN Confidence < 0.35 THEN 'low_conf<0.35' END, CASE WHEN NormalizedTime IS NULL THEN 'invalid_time' END], lambda x: x IS NOT NULL)) AS Warnings,
  NormalizedTime IS NOT NULL AS IsValid FROM ({_EXPORT})"""
_FAILED = cleaned(f"SELECT * FROM ({_EXPORT}) WHERE NOT IsValid OR list_contains(Warnings, 'low_conf<0.35')", "RawText", "CleanText")

_CANDS = f"SELECT o_orderkey, k AS pos, {q._CANDIDATE} AS cand, k * -0.25::DOUBLE AS logp FROM orders, (SELECT unnest([0, 1, 2, 3]) AS k)"
_NORM = f"SELECT *, regexp_replace(trim(cand), '\\s+', ' ', 'g') AS norm FROM ({_CANDS})"
_SCORED = amount(f"SELECT *, coalesce(san, norm) AS clean FROM ({amount(_NORM, 'norm', 'san')})", "clean", "again")
_SCORED = f"""SELECT *, logp - CASE WHEN regexp_full_match(norm, '[()$\\s0-9.,-]+') THEN 0 ELSE 3 END + CASE WHEN san IS NOT NULL THEN 2 ELSE 0 END + CASE WHEN again IS NOT NULL THEN 1.5 ELSE 0 END
  - 0.05::DOUBLE * levenshtein(norm, clean) AS s, array_to_string(list_filter([CASE WHEN NOT regexp_full_match(norm, '[()$\\s0-9.,-]+') THEN 'prefilter_fail' END,
  CASE WHEN san IS NOT NULL THEN 'sanitized_ok' END, CASE WHEN again IS NOT NULL THEN 'amount_valid' END, CASE WHEN levenshtein(norm, clean) > 0 THEN 'lev-' || cast(levenshtein(norm, clean) AS string) END], lambda x: x IS NOT NULL), ',') AS bits
  FROM ({_SCORED})"""
_LOCAL = amount(f"SELECT *, trim(cand) AS raw, replace(trim(cand), ' ', '') AS compact FROM ({_CANDS})", "compact", "san")
_TRIAGE = amount(f"""SELECT o_orderkey, cand AS pred, 1 / (1 + exp(0.25::DOUBLE * -(o_orderkey % 9)) + exp(0.5::DOUBLE * -(o_orderkey % 9)) + exp(0.75::DOUBLE * -(o_orderkey % 9))) AS conf
  FROM ({_CANDS}) WHERE pos = 3""", "pred", "san")

_TAGS = lenient(lenient(f"""SELECT o_orderkey, pred, coalesce(gt, '') AS gt FROM (SELECT o_orderkey, {q._PRED} AS pred FROM orders) LEFT JOIN
  (SELECT o_orderkey, CASE WHEN o_orderkey % 13 = 0 THEN '' ELSE {q._TRUTH} END AS gt FROM orders WHERE o_orderkey % 11 <> 0) USING (o_orderkey)""", "pred", "pred_time"), "gt", "gt_time")
_TAGS = f"SELECT *, CASE WHEN pred_time IS NULL THEN 'INVALID_PRED' WHEN gt_time IS NULL THEN 'INVALID_GT' WHEN pred_time = gt_time THEN 'OK' ELSE 'MISMATCH' END AS tag FROM ({_TAGS})"


def _eval() -> str:
    each = lambda e, fn: f"SELECT o_orderkey, coalesce(v, trim(coalesce(raw, ''))) AS v FROM ({fn(f'SELECT o_orderkey, {e} AS raw FROM orders', 'raw', 'v')})"
    plain = lambda src, raw, out: f"SELECT *, NULL::VARCHAR AS {out} FROM ({src})"
    note = "CASE WHEN o_orderkey % 2 = 0 THEN o_orderpriority END"
    parts = []
    for col, want, got, fn in (("in_am", q._TRUTH, q._PRED, strict), ("note", "' ' || o_orderpriority", note, plain), ("day", samples.DATE, samples.DATE, day)):
        parts.append(f"""SELECT '{col}' AS col, (CASE WHEN t.o_orderkey % 7 <> 0 THEN p.v ELSE '' END = t.v)::BIGINT AS ok FROM ({each(want, fn)}) t JOIN ({each(got, fn)}) p USING (o_orderkey)""".replace("t.o_orderkey % 7", "o_orderkey % 7"))
    return f"""SELECT col, count(*)::BIGINT AS total, sum(ok)::BIGINT AS exact, round(sum(ok) / count(*), 6) AS rate FROM ({' UNION ALL '.join(parts)}) GROUP BY GROUPING SETS ((col), ())"""


_LOG = "SELECT cast(user_id AS string) AS crop_path, CASE WHEN event_type = 'error' THEN '' ELSE event_type || ':' || cast(event_id % 24 AS string) END AS label, event_id AS pos FROM events"
_LATEST = f"SELECT crop_path, arg_max(label, pos) AS label, max(pos) AS pos FROM ({_LOG}) GROUP BY crop_path"
_GOLD = f"SELECT crop_path, CASE WHEN pos % 2 = 0 THEN cast(pos % 24 AS string) || ';30' ELSE label END AS label, pos FROM ({_LOG})"
_GOLD = f"SELECT crop_path, arg_max(label, pos) AS label FROM ({_GOLD}) WHERE trim(label) <> '' GROUP BY crop_path"

_T = f"(({q._CY}) - 510) / 120.0"
_AT = f"least(greatest(round_even(({_T})::DOUBLE, 0), 0), 11)"
_MID = f"least(greatest(round_even(({_T})::DOUBLE - 0.5, 0), 0), 11)"
_ROW = f"CASE WHEN abs(({q._CY})::DOUBLE - 510 - 120 * ({_AT} + 0.5::DOUBLE)) <= 66 THEN {_AT}::INT END"

#: The form, stated apart from the library: names, types and widths of columns; margin 80, data from 510 on, twelve bands of 120.
_COLS = """(0, 'employee_name', 'text', 260), (1, 'in_am', 'time', 170), (2, 'out_am', 'time', 170), (3, 'lunch', 'time', 140), (4, 'in_pm', 'time', 170),
  (5, 'out_pm', 'time', 170), (6, 'total_hours', 'amount', 170), (7, 'signature', 'text', 210)"""
_OFFSETS = f"SELECT *, 80 + coalesce(sum(width) OVER (ORDER BY col_idx ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS x0 FROM (VALUES {_COLS}) v(col_idx, name, ftype, width)"
_DET = f"""SELECT l_orderkey AS page_id, l_linenumber AS det_idx, floor(x0 + width / 2) + l_partkey % 61 - 30 AS cx, (l_orderkey % 12)::INT AS row_idx, CASE WHEN l_suppkey % 10 = 0 THEN 'date' ELSE 'field' END AS cls
  FROM (SELECT l_orderkey, l_linenumber, min(l_partkey) AS l_partkey, min(l_suppkey) AS l_suppkey FROM lineitem GROUP BY ALL) JOIN ({_OFFSETS}) ON l_linenumber - 1 = col_idx"""
_CENTERS = f"SELECT col_idx, name, floor(x0 + width / 2) AS c FROM ({_OFFSETS})"

_FIELDS = f"""SELECT (l_orderkey * 10 + l_linenumber) * 1000000 + l_partkey AS pos, {samples.PAGE} AS page_image, {samples.FIELD} AS field_name, cast(l_partkey % 1500 AS int) AS x, cast(l_suppkey % 2000 AS int) AS y,
  cast(20 + l_linenumber AS int) AS w, cast(30 + l_orderkey % 7 AS int) AS h FROM lineitem"""
_DIM = "(0, 'employee_name'), (1, 'in_am'), (2, 'out_am'), (3, 'lunch'), (4, 'in_pm'), (5, 'out_pm'), (6, 'total_hours'), (7, 'signature'), (8, 'date')"
_TYPED = f"SELECT * FROM (SELECT *, split_part(field_name, '_r', 1) AS cls FROM ({_FIELDS})) JOIN (VALUES {_DIM}) d(cid, name) ON cls = name"
_NUMBER = "('0x' || substr(md5(page_image), 1, 12))::BIGINT"
_COCO = f"""WITH own AS (SELECT *, min(pos) OVER (PARTITION BY page_image) AS f FROM ({_TYPED}) WHERE cid < 8)
  SELECT row_number() OVER (ORDER BY f, page_image, pos)::BIGINT AS id, {_NUMBER} AS image_id, cid + 1 AS category_id,
  concat_ws(',', x, y, w, h) AS bbox, w * h AS area, 0 AS iscrowd FROM own"""
_BUCKET = """CASE WHEN regexp_matches({0}, 'clock_in|clock_out') THEN 'time' WHEN contains({0}, 'lunch') THEN 'lunch' WHEN contains({0}, 'total_hours') THEN 'total_hours'
  WHEN contains({0}, 'employee_name') THEN 'name' WHEN contains({0}, 'signature') THEN 'signature' ELSE 'other' END"""
_TYPE = "CASE WHEN regexp_matches(lower({0}), 'clock_(in|out)_(am|pm)$') THEN 'time' WHEN regexp_matches(lower({0}), 'total_hours$') THEN 'amount' END"

_P, _S = "(l_partkey % 900)", "l_suppkey"
_CORNERS = f"""CASE l_linenumber % 5 WHEN 0 THEN [{_P}, 10, trunc({_P} + 20.5), 10 + {_S} % 50]
  WHEN 1 THEN CASE WHEN {_S} % 900 > {_P} THEN [{_P}, 5, {_S} % 900, 40] ELSE [{_P}, 5, {_P} + {_S} % 900, 45] END
  WHEN 2 THEN [1, 2, {_P}, 9] WHEN 3 THEN [least(1, {_P}, 7, 0), least(2, {_S} % 50), greatest(1, {_P}, 7, 0), greatest(2, {_S} % 50, 8)] END"""
_CORNERS = f"list_transform({_CORNERS}, lambda v: v::INT)"

_LINT = lines(
    raw=f"CASE WHEN l_partkey % 3 = 0 THEN {samples.TIME} WHEN l_partkey % 3 = 1 THEN cast(l_suppkey AS string) || '.00' ELSE lpad(cast(l_orderkey % 24 AS string), 2, '0') || ':' || lpad(cast(l_partkey % 60 AS string), 2, '0') END",
    here="l_suppkey % 20 <> 0", split="CASE WHEN l_orderkey % 10 = 0 THEN 'val' ELSE 'train' END",
)
_LINT = amount(strict(_LINT, "raw", "t"), "raw", "m")

_KEYS = f"{samples.KEY} || cast(l_orderkey AS string) || CASE l_linenumber % 7 WHEN 0 THEN '_clock_in_am' WHEN 2 THEN '_total_hours' ELSE '' END"
_VALUES = f"CASE l_linenumber % 7 WHEN 0 THEN {samples.TIME} WHEN 2 THEN {samples.AMOUNT} WHEN 3 THEN '<EMPTY>' ELSE ' plain ' END"
_IMPORT = f"SELECT l_suppkey AS image_id, l_orderkey, {_KEYS} AS key, {_VALUES} AS value, {_CORNERS} AS b FROM lineitem"
_LINES = f"SELECT l_suppkey AS image_id, {_KEYS} AS key, {_VALUES} AS value FROM lineitem"
_BOXES = f"SELECT CASE WHEN l_orderkey % 5 = 0 THEN 'no ' ELSE '' END || l_suppkey AS image_id, {_KEYS} AS key, {_CORNERS} AS b FROM lineitem"
_IMPORT = f"""SELECT l.image_id, l.key, l.value, {_TYPE.format('l.key')} AS ftype, x.b FROM ({_IMPORT}) l JOIN (SELECT * FROM ({_IMPORT}) WHERE l_orderkey % 5 <> 0) x
  ON l.image_id = x.image_id AND l.key = x.key WHERE x.b IS NOT NULL"""
_IMPORT = amount(strict(_IMPORT, "value", "t"), "value", "m")
_PAD = lambda b: f"[greatest({b}[1] - 2, 0), greatest({b}[2] - 2, 0), least({b}[3] + 2, 1700), least({b}[4] + 2, 2200)]"

_WORK = lines(a0="cast(l_orderkey % 12 AS string) || ':' || lpad(cast(l_partkey % 60 AS string), 2, '0')", b0="cast(12 + l_suppkey % 12 AS string) || lpad(cast(l_partkey % 60 AS string), 2, '0')")

_TEXT = "CASE WHEN o_orderkey % 5 = 0 THEN '9.' || o_custkey % 60 ELSE o_custkey % 26 || ':' || lpad(cast(o_orderkey % 64 AS string), 2, '0') END"
_NUMBERED = "SELECT *, o_orderkey % 7 AS shape, 's' || o_orderkey % 10 AS own, row_number() OVER (PARTITION BY o_orderkey % 10 ORDER BY o_orderkey) AS line FROM orders"
_READ = f"""SELECT CASE WHEN o_orderkey % 4 = 0 THEN 'T' || o_custkey % 7 ELSE 'sheet=' || own END AS TimesheetID, cast(o_orderkey % 12 AS string) AS Row, 'row' || o_orderkey % 9 || '_clock_in_am' AS FieldKey,
    {_TEXT} AS RawText, CASE WHEN o_orderkey % 9 = 0 THEN 'x' ELSE '0.' || o_orderkey % 9 END AS Confidence, 'c/img' || o_custkey || '/ROW' || o_orderkey % 9 || '_clock_in_AM.png' AS CropPath,
    CASE WHEN o_orderkey % 8 = 3 THEN ['blurred'] ELSE [] END AS own_w, line, 0 AS item FROM ({_NUMBERED}) WHERE shape IN (0, 1, 2, 6)
  UNION ALL SELECT 'sheet=' || own, NULL, NULL, '7', NULL, NULL, [], line, 1 FROM ({_NUMBERED}) WHERE shape = 1
  UNION ALL SELECT 'sheet=' || own, NULL, NULL, cast(o_custkey % 2400 AS string), NULL, NULL, [], line, 0 FROM ({_NUMBERED}) WHERE shape = 3
  UNION ALL SELECT 'sheet=' || own, NULL, NULL, NULL, NULL, NULL, ['jsonl_line_error:' || line], line, 0 FROM ({_NUMBERED}) WHERE shape = 5"""
_READ = f"""SELECT *, list_concat(own_w, w, list_filter([CASE WHEN try_cast(Confidence AS DOUBLE) < 0.35 THEN 'low_conf<0.35' END, CASE WHEN NormalizedTime IS NULL THEN 'invalid_time' END], lambda x: x IS NOT NULL)) AS all_w,
  NormalizedTime IS NOT NULL AS ok FROM ({parsed(_READ, 'RawText', 'NormalizedTime', 'w')})"""

_GREEDY = """WITH RECURSIVE dets AS (
  SELECT l_orderkey // 24 AS page_id, (l_orderkey // 2) % 12 AS row_idx, list({'x': x, 'i': i}) AS d FROM (
    SELECT l_orderkey, l_orderkey * 10 + l_linenumber AS i, (min(l_partkey) * 37 % 1400 + 80)::DOUBLE AS x FROM lineitem GROUP BY l_orderkey, l_linenumber) GROUP BY ALL
), walk AS (
  SELECT page_id, row_idx, d, -1 AS col_idx, NULL::BIGINT AS det_idx FROM dets
  UNION ALL
  SELECT page_id, row_idx, list_filter(d, lambda e: e.i <> p.i), c, p.i FROM (
    SELECT *, col_idx + 1 AS c, list_sort(list_transform(d, lambda e: {'far': abs(e.x - [210, 425, 595, 750, 905, 1075, 1245, 1435][col_idx + 2]), 'i': e.i}))[1] AS p FROM walk WHERE col_idx < 7 AND len(d) > 0)
)
SELECT page_id, row_idx::INT AS row_idx, col_idx, det_idx FROM walk WHERE col_idx >= 0"""


def ranked(kind: str, sanitize, allowed: str) -> str:
    """Ranking of the candidates of a kind."""
    cands = f"SELECT *, regexp_replace(trim(cand), '\\s+', ' ', 'g') AS norm FROM (SELECT o_orderkey, pos, {q.CANDIDATES[kind]} AS cand, pos * -0.25::DOUBLE AS logp FROM orders, (SELECT unnest([0, 1, 2]) AS pos))"
    good, typed = f"({allowed})", kind != "text"
    both = sanitize(f"SELECT *, coalesce(san, norm) AS clean FROM ({sanitize(cands, 'norm', 'san')})", "clean", "again") if typed else f"SELECT *, norm AS san, norm AS clean, NULL AS again FROM ({cands})"
    scored = f"""SELECT *, logp - CASE WHEN {good} THEN 0 ELSE 2 END + CASE WHEN san IS NOT NULL THEN 2 ELSE 0 END + CASE WHEN again IS NOT NULL THEN 1.5 ELSE 0 END - 0.05::DOUBLE * levenshtein(norm, clean) AS s,
      array_to_string(list_filter([CASE WHEN NOT {good} THEN 'prefilter_fail' END, CASE WHEN san IS NOT NULL THEN 'sanitized_ok' END, CASE WHEN again IS NOT NULL THEN '{kind}_valid' END,
      CASE WHEN levenshtein(norm, clean) > 0 THEN 'lev-' || cast(levenshtein(norm, clean) AS string) END], lambda x: x IS NOT NULL), ',') AS bits FROM ({both})"""
    return f"SELECT o_orderkey, pos::BIGINT AS pos, cand, round(s, 6) AS score, CASE WHEN bits = '' THEN 'ok' ELSE bits END AS note, row_number() OVER (PARTITION BY o_orderkey ORDER BY s DESC, length(norm), pos)::BIGINT AS rank FROM ({scored})"


_CROPS = "SELECT l_orderkey, l_linenumber AS n, min(l_partkey) AS p, min(l_suppkey) AS s FROM lineitem GROUP BY l_orderkey, l_linenumber"
_CROPS = f"SELECT *, CASE WHEN n = 2 THEN p || ',5' WHEN n = 5 AND p % 2 = 0 THEN '?none' ELSE p % 24 || '.15' END AS hint FROM ({_CROPS})"
_ROUTED = f"SELECT *, CASE n WHEN 1 THEN coalesce(t, hint) WHEN 5 THEN coalesce(t, hint) WHEN 2 THEN coalesce(m, hint) WHEN 3 THEN CASE WHEN s % 3 = 0 THEN 'present' ELSE 'absent' END ELSE '' END AS v FROM ({amount(strict(_CROPS, 'hint', 't'), 'hint', 'm')})"

_IMAGES = f"SELECT DISTINCT {_NUMBER} AS id, page_image FROM ({_TYPED}) WHERE cid < 8"
_ANNOTATIONS = _COCO.replace("concat_ws(',', x, y, w, h) AS bbox", "'[' || concat_ws(',', x, y, w, h) || ']' AS bbox")
_COCO_LINES = f"""SELECT 0 AS part, 0::BIGINT AS at, '{{"images":[' AS value
  UNION ALL SELECT 1, id, CASE WHEN row_number() OVER (ORDER BY id) > 1 THEN ',' ELSE '' END || '{{"id":' || id || ',"file_name":"' || page_image || '","width":0,"height":0}}' FROM ({_IMAGES})
  UNION ALL SELECT 2, 0, '],"annotations":['
  UNION ALL SELECT 3, id, CASE WHEN id > 1 THEN ',' ELSE '' END || '{{"id":' || id || ',"image_id":' || image_id || ',"category_id":' || category_id || ',"bbox":' || bbox || ',"area":' || area || ',"iscrowd":0}}' FROM ({_ANNOTATIONS})
  UNION ALL SELECT 4, 0, '],"categories":[' || (SELECT string_agg('{{"id":' || i + 1 || ',"name":"' || n || '"}}', ',' ORDER BY i) FROM (VALUES {_DIM}) v(i, n) WHERE i < 8) || ']}}'"""

_FOUND = f"SELECT *, '{{\"cls\":\"' || cls || '\",\"bbox\":[' || (cx - 20)::DOUBLE || ',' || (510 + row_idx * 120 - 15)::DOUBLE || ',40.0,30.0],\"score\":0.9}}' AS j FROM ({_DET})"
_PAGE = f"""SELECT page_id, '{{"image":"' || page_id || '","meta":{{"crop_version":"v1","header_rows":2}},"table_top_data":510,"row_h":120,"rows_data":12,"col_widths":[260,170,170,140,170,170,170,210],"detections":['
    || string_agg(j, ',' ORDER BY det_idx) FILTER (WHERE j IS NOT NULL) || '],"grid":{{' || any_value(g) || '}}}}' AS result FROM ({_FOUND}) JOIN (
      SELECT page_id, string_agg('"' || r || ',' || c || '":' || coalesce(j, 'null'), ',' ORDER BY r, c) AS g FROM (SELECT DISTINCT page_id FROM ({_DET})), (SELECT unnest(range(12)) AS r), (SELECT unnest(range(8)) AS c)
      LEFT JOIN (SELECT page_id AS p, row_idx, det_idx - 1 AS col, j FROM ({_FOUND}) WHERE cls <> 'date') ON p = page_id AND row_idx = r AND col = c GROUP BY page_id) USING (page_id) GROUP BY page_id"""

_DRAW = lambda salt, m: f"('0x' || substr(md5('42|' || page || '|' || r || '|' || c || '|{salt}'), 1, 12))::BIGINT % {m}"
_HHMM = lambda m: f"lpad(cast(({m}) // 60 AS string), 2, '0') || ':' || lpad(cast(({m}) % 60 AS string), 2, '0')"
_PERSON = f"['Ann', 'Ben', 'Cal', 'Dee', 'Eve', 'Fay'][{_DRAW('first', 6)} + 1] || ' ' || ['Hill', 'Lake', 'Moor', 'Reed', 'Vale', 'Wood'][{_DRAW('last', 6)} + 1]"
_BOXED = f"""SELECT r::INT AS r, col_idx AS c, name, ftype, (x0 + 8)::INT AS bx, (458 + r * 120)::INT AS bw0, (width - 16)::INT AS bw, 104 AS bh FROM ({_OFFSETS}), (SELECT unnest(range(12)) AS r)"""
_HEADS = "SELECT -1 AS r, c, name, 'text' AS ftype, x AS bx, y AS bw0, w AS bw, h AS bh FROM (VALUES (0, 'company', 200, 150, 500, 50), (1, 'supervisor', 200, 224, 480, 50), (2, 'date', 1360, 150, 240, 50)) v(c, name, x, y, w, h)"
_SYNTH = f"""SELECT *, CASE WHEN r < 0 THEN name ELSE name || '_r' || (r + 1) END AS field_name, CASE WHEN name IN ('employee_name', 'supervisor') THEN {_PERSON}
    WHEN name = 'company' THEN ['Hill', 'Lake', 'Moor', 'Reed', 'Vale', 'Wood'][{_DRAW('last', 6)} + 1] || ' Works'
    WHEN name = 'date' THEN printf('%02d/%02d/%d', {_DRAW('month', 12)} + 1, {_DRAW('day', 28)} + 1, {_DRAW('year', 2)} + 2024)
    WHEN name = 'lunch' THEN {_HHMM(_DRAW('lunch', 5) + ' * 15')} WHEN name = 'signature' THEN CASE WHEN {_DRAW('sign', 10)} < 8 THEN 'present' ELSE 'absent' END
    WHEN ftype = 'amount' THEN printf('%.2f', ({_DRAW('cents', 1200)}) / 100.0) ELSE {_HHMM('(' + _DRAW('hour', 14) + ' + 6) * 60 + ' + _DRAW('quarter', 4) + ' * 15')} END AS text
  FROM (SELECT unnest(range(200)) AS page), ({_HEADS} UNION ALL {_BOXED})"""
_SYNTH = f"""SELECT image, text, ftype AS field_type, 'pages/page_' || page || '.jpg' AS page_image, field_name, concat_ws(',', bx, bw0, bw, bh) AS bbox_xywh,
  CASE WHEN r >= 0 THEN name = 'signature' AND text = 'present' END AS signature_present, CASE WHEN ('0x' || substr(md5('42|' || image), 1, 12))::BIGINT % 1000000 < 100000 THEN 'val' ELSE 'train' END AS split
  FROM (SELECT *, 'crops/page_' || page || '_' || field_name || '.jpg' AS image FROM ({_SYNTH}))"""
_ESCAPED = lambda x: f"replace(replace(replace(replace(replace({x}, '&', '&amp;'), '<', '&lt;'), '>', '&gt;'), '\"', '&quot;'), '''', '&#x27;')"
_TYPED_TEXT = "CASE WHEN trim(value) IN ('', '<EMPTY>', '<ILLEGIBLE>', '<SIGNATURE>', 'NA', 'N/A') THEN NULL WHEN ftype = 'time' THEN t WHEN ftype = 'amount' THEN m ELSE trim(value) END"
_LOGGED = " UNION ALL ".join(f"SELECT {b} AS b, user_id, max(event_id) AS e, arg_max(event_type, event_id) AS kind FROM events WHERE event_id % {n} = 0 GROUP BY user_id" for b, n in enumerate((97, 11, 2)))
_PROBED = """(1, 'fields,image,image_id,labels', 'p1.png', 'list', 'key,text'), (2, 'fields,image_path', 'x.png', 'dict', 'a,b'), (3, 'other', NULL, 'none', NULL)"""
_LISTED = "('a.JPG', 0), ('b.png', 1), ('c.tif', 2), ('d.TIFF', 3), ('f.webp', 4), ('g.BMP', 5), ('h.jpeg', 6), ('i.png', NULL)"

SQL: dict[str, str] = {
    "export_files": f"""SELECT 'run1' AS RunID, TimesheetID, Row, FieldKey, RawText, NormalizedTime, Confidence, CropPath, nullif(array_to_string(all_w, '; '), '') AS Warnings,
      CASE WHEN ok THEN 'True' ELSE 'False' END AS IsValid, cast(line AS string) AS line, cast(item AS string) AS item FROM ({_READ})""",
    "export_summary_files": f"""SELECT 'run1' AS RunID, TimesheetID, cast(count(*) AS string) AS Records, cast(sum(ok::INT) AS string) AS ValidRecords, cast({mean('ok::INT')} AS string) AS PctValid,
      cast({mean('try_cast(Confidence AS DOUBLE)')} AS string) AS AvgConfidence FROM ({_READ}) GROUP BY TimesheetID""",
    "json_documents": """SELECT c_nationkey, c_name AS raw_text, NULL::VARCHAR AS fault FROM customer WHERE c_nationkey % 5 < 3
      UNION ALL SELECT DISTINCT c_nationkey, CASE WHEN c_nationkey % 5 = 3 THEN '17' END, CASE WHEN c_nationkey % 5 = 4 THEN 'json_error:' END FROM customer WHERE c_nationkey % 5 > 2""",
    "keyed_rows": "SELECT o_custkey % 50 AS row, arg_max(o_orderpriority || o_orderkey, o_orderkey) AS text, max(o_orderkey) AS pos FROM orders GROUP BY 1",
    "label_log_latest": f"""SELECT cast(user_id AS string) AS crop_path, CASE WHEN b = 1 THEN '' ELSE 'p' END AS pred_raw, CASE WHEN e % 6 > 0 THEN b || ', "' || kind || '"' WHEN b = 1 THEN ' ' ELSE '<EMPTY>' END AS label, (9 - b)::BIGINT AS ts
      FROM (SELECT * FROM ({_LOGGED}) QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY b DESC) = 1)""",
    "label_folder": "SELECT n_name AS image_id, 'clock_in' AS field_name, CASE WHEN n_nationkey % 3 > 0 THEN n_name ELSE '' END AS text, '1,2,' || n_nationkey || ',4' AS bbox FROM nation",
    "newest_csv": "SELECT n_nationkey::BIGINT AS n_nationkey, n_name || ' 20251013_120000' AS name FROM nation",
    "image_files": f"SELECT name, place, CASE WHEN place IS NOT NULL THEN true END AS listed, true AS below FROM (VALUES {_LISTED}) v(name, place)",
    "schema_probe": f"SELECT line::BIGINT AS line, keys, image, kind, field_keys FROM (VALUES {_PROBED}) v(line, keys, image, kind, field_keys)",
    "record_columns": """SELECT (row_number() OVER (ORDER BY name) - 1)::INT AS place, name FROM (SELECT 'row' AS name UNION SELECT 'in_am' UNION SELECT 'k' || o_custkey % 4 FROM orders WHERE o_orderkey % 2 = 1)""",
    "first_in_order": """SELECT l_orderkey, l_linenumber, CASE WHEN l_orderkey % 50 >= 48 THEN l_orderkey % 50 END AS TimesheetID, CASE WHEN l_partkey % 3 > 0 THEN l_partkey % 3 END AS Page, l_suppkey % 12 AS Row, l_linenumber AS Col
      FROM lineitem ORDER BY TimesheetID NULLS LAST, Page NULLS LAST, Row, Col, l_orderkey, l_partkey LIMIT 500""",
    "import_funnel": f"""SELECT count(DISTINCT l.image_id) AS lines, count(DISTINCT l.image_id) FILTER (WHERE file) AS img_ok, count(*) AS fields, count_if(file AND b IS NOT NULL)::BIGINT AS bbox,
      count_if(file AND b IS NOT NULL AND trim(value) NOT IN ('', '<EMPTY>', '<ILLEGIBLE>', '<SIGNATURE>', 'NA', 'N/A'))::BIGINT AS text
      FROM (SELECT *, image_id % 3 > 0 AS file FROM ({_LINES})) l LEFT JOIN ({_BOXES}) x ON cast(l.image_id AS string) = x.image_id AND l.key = x.key""",
    "import_split": f"""SELECT crop, ftype, text, CASE WHEN ('0x' || substr(md5('13|' || crop), 1, 12))::BIGINT % 1000000 < 150000 THEN 'val' ELSE 'train' END AS split
      FROM (SELECT image_id || '__' || key AS crop, ftype, {_TYPED_TEXT} AS text FROM ({_IMPORT})) WHERE text IS NOT NULL AND ftype IS NOT NULL""",
    "assembled_rows": """SELECT l_orderkey AS row, arg_max(s, n) FILTER (WHERE n % 3 = 0) AS in_am, arg_max(s, n) FILTER (WHERE n % 3 = 1) AS out_am, arg_max(s, n) FILTER (WHERE n % 3 = 2) AS note
      FROM (SELECT l_orderkey, l_linenumber AS n, cast(min(l_suppkey) AS string) AS s FROM lineitem GROUP BY ALL) GROUP BY l_orderkey""",
    "best_epochs": """SELECT cast(d AS string) AS epoch, em, em > coalesce(max(em) OVER (ORDER BY d ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), -1) AS is_best
      FROM (SELECT o_orderdate::DATE AS d, max(o_custkey)::DOUBLE AS em FROM orders GROUP BY 1)""",
    "sequence_scores": """SELECT l_orderkey, sum(lp) FILTER (WHERE n <= coalesce(e, n)) AS logprob FROM (SELECT *, min(n) FILTER (WHERE tok = 3) OVER (PARTITION BY l_orderkey) AS e FROM (
      SELECT l_orderkey, l_suppkey % 4 AS tok, -l_quantity / 8 AS lp, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey % 4, -l_quantity / 8) AS n FROM lineitem)) GROUP BY l_orderkey""",
    "hashed_names": """SELECT p_partkey, CASE p_partkey % 3 WHEN 0 THEN '.hidden__' || h WHEN 1 THEN p_name || '.v1__' || h || '.png' ELSE p_name || '__' || h END AS name FROM (SELECT *, substr(sha1('/data/' || p_brand || '/' ||
      CASE p_partkey % 3 WHEN 0 THEN '.hidden' WHEN 1 THEN p_name || '.v1.png' ELSE p_name END), 1, 16) AS h FROM part)""",
    "warnings_split": "SELECT l_orderkey, l_linenumber, CASE l_linenumber % 4 WHEN 1 THEN 'a|b' || l_suppkey WHEN 3 THEN 'invalid_time' ELSE '' END AS warnings FROM lineitem",
    "grid_greedy": _GREEDY,
    "nbest_time": ranked("time", strict, r"regexp_full_match(norm, '[\s0-9:;.,apmAPM-]+')"),
    "nbest_date": ranked("date", day, r"regexp_full_match(norm, '[\s0-9/.-]+')"),
    "nbest_text": ranked("text", None, "true"),
    "layout_drawn": f"SELECT name || CASE WHEN r < 0 THEN '' ELSE '_r' || (r + 1) END AS name, bx, bw0 AS by, bw, bh FROM ({_HEADS} UNION ALL {_BOXED})",
    "stub_grid": """SELECT cast(l_orderkey AS string) AS page_id, (l_orderkey % 12)::INT AS row_idx, l_linenumber AS det_idx, (120 + (l_linenumber - 1) * 170)::DOUBLE AS x, 90::DOUBLE AS w, 0.999::DOUBLE AS score
      FROM (SELECT l_orderkey, l_linenumber, min(l_partkey) AS p FROM lineitem GROUP BY ALL) WHERE p % 20 > 0""",
    "router_rows": f"""SELECT l_orderkey AS row, coalesce(max(v) FILTER (WHERE n = 5), max(v) FILTER (WHERE n = 1)) AS in_am, {', '.join(f"max(v) FILTER (WHERE n = {n}) AS {c}" for n, c in ((2, 'total_hours'), (3, 'signature'), (4, 'employee_name'), (6, 'date')))},
      max(v) FILTER (WHERE n > 6) AS unknown FROM ({_ROUTED}) GROUP BY l_orderkey""",
    "coco_lines": _COCO_LINES,
    "yolo_files": f"SELECT page_image, string_agg(line, chr(10) ORDER BY pos, line) AS value FROM (SELECT page_image, pos, printf('%d %.6f %.6f %.6f %.6f', cid, (x + w / 2.0::DOUBLE) / 1700, (y + h / 2.0::DOUBLE) / 2200, w / 1700.0::DOUBLE, h / 2200.0::DOUBLE) AS line FROM ({_TYPED})) GROUP BY page_image",
    "failure_review": f"SELECT TimesheetID, RawText, CleanText AS PrecleanedCandidate, NormalizedTime, Confidence, coalesce(Warnings[1], '') AS Reason, array_to_string(Warnings, '; ') AS Warnings FROM ({_FAILED})",
    "review_page": f"""SELECT 1 AS part, conv_id * 1000 + turn AS at, '<tr><td>' || {_ESCAPED("coalesce(role, '')")} || '</td><td>' || {_ESCAPED("coalesce(text, '')")} || '</td></tr>' AS value FROM conversations
      UNION ALL SELECT 0, 0, '<!doctype html><meta charset="utf-8"/><table><tr><th>role</th><th>text</th></tr>' UNION ALL SELECT 2, 0, '</table>'""",
    "review_list": """SELECT row_number() OVER (ORDER BY c_custkey) - 1 AS idx, 'c/' || c_name AS crop_path, 'time' AS field_type, raw AS pred_raw, raw AS suggest
      FROM (SELECT *, CASE WHEN c_custkey % 3 = 2 THEN '9:30' WHEN c_custkey % 4 = 0 THEN '' ELSE c_mktsegment END AS raw FROM customer)""",
    "split_bernoulli": "SELECT o_orderkey, CASE WHEN ('0x' || substr(md5('13|' || o_orderkey), 1, 12))::BIGINT % 1000000 < 100000 THEN 'val' ELSE 'train' END AS split FROM orders",
    "export_stream": f"""SELECT c_custkey, RawText, NormalizedTime, array_to_string(list_concat(w, list_filter([CASE WHEN c_custkey % 10 < 4 THEN 'low_conf<0.35' END, CASE WHEN NormalizedTime IS NULL THEN 'invalid_time' END], lambda x: x IS NOT NULL)), '; ') AS Warnings,
      NormalizedTime IS NOT NULL AS IsValid FROM ({parsed("SELECT c_custkey, c_custkey % 26 || ':' || lpad(cast(c_nationkey * 3 AS string), 2, '0') AS RawText FROM customer", "RawText", "NormalizedTime", "w")})""",
    "synth_crops": _SYNTH,
    "page_json": _PAGE,
    "export_time_detail": f"SELECT l_orderkey, l_linenumber, RawText, NormalizedTime, array_to_string(Warnings, '; ') AS Warnings, IsValid::INT AS IsValid FROM ({_EXPORT})",
    "export_time_summary": f"SELECT TimesheetID, count(*)::BIGINT AS Records, sum(IsValid::INT)::BIGINT AS ValidRecords, {mean('IsValid::INT')} AS PctValid, {mean('Confidence')} AS AvgConfidence FROM ({_EXPORT}) GROUP BY TimesheetID",
    "time_three_way": f"SELECT * EXCLUDE (w) FROM ({parsed(lenient(strict(lines(raw=samples.TIME), 'raw', 'strict'), 'raw', 'lenient'), 'raw', 'parsed', 'w')})",
    "amount_sanitize": amount(lines(raw=samples.AMOUNT), "raw", "amount"),
    "amount_canon": f"""SELECT * EXCLUDE (t, a, b) FROM (SELECT *, regexp_replace(replace(raw, ',', '.'), '[^0-9.]', '', 'g') AS t, split_part(t, '.', 1) AS a, replace(substr(t, length(a) + 1), '.', '') AS b,
      CASE WHEN t IN ('', '.') THEN '' ELSE cast(CASE WHEN a = '' THEN 0 ELSE a::BIGINT END AS string) || '.' || left(b || '00', 2) END AS canon FROM ({lines(raw=samples.AMOUNT)}))""",
    "date_sanitize": day(f"SELECT o_orderkey, {samples.DATE} AS raw FROM orders", "raw", "day"),
    "minutes_worked": f"""SELECT l_orderkey, l_linenumber, m AS minutes, CASE WHEN h < 0 AND h > -10 THEN cast(h AS string) ELSE {two('h')} END || ':' || lpad(cast(m - h * 60 AS string), 2, '0') AS worked FROM (SELECT *,
      (left(b, 2)::INT * 60 + right(b, 2)::INT - left(a, 2)::INT * 60 - right(a, 2)::INT) AS m, floor(m / 60)::INT AS h FROM ({lenient(lenient(_WORK, 'a0', 'a'), 'b0', 'b')}))""",
    "alias_coalesce": """SELECT o_orderkey, CASE o_orderkey % 4 WHEN 0 THEN 'a' || o_custkey WHEN 1 THEN 'b' || o_custkey WHEN 2 THEN cast(o_custkey AS string) END AS raw_text,
      CASE o_orderkey % 4 WHEN 0 THEN '0.' || (o_orderkey % 10) WHEN 1 THEN 'x' END AS confidence FROM orders""",
    "json_shapes": """SELECT o_orderkey, i::BIGINT AS item, CASE o_orderkey % 6 WHEN 0 THEN 't' || o_custkey WHEN 1 THEN CASE i WHEN 0 THEN 'x' ELSE 'y' || o_custkey END
        WHEN 2 THEN ['r', 's', 't'][i + 1] WHEN 3 THEN cast(o_custkey AS string) END AS raw_text, CASE WHEN o_orderkey % 6 = 5 THEN 'jsonl_line_error:' || o_orderkey END AS fault
      FROM (SELECT *, unnest(range([1, 2, 3, 1, 0, 1][(o_orderkey % 6 + 1)::INT])) AS i FROM orders)""",
    "row_col_infer": """SELECT l_orderkey, l_linenumber, CASE WHEN l_linenumber % 3 = 0 THEN l_suppkey % 9 ELSE l_partkey % 12 END::INT AS row, CASE WHEN l_orderkey % 2 = 0 THEN 77 ELSE l_linenumber END::INT AS col FROM lineitem""",
    "crop_path_parse": "SELECT l_orderkey, l_linenumber, 'img' || l_suppkey AS image_id, 'row' || l_partkey % 12 || '_clock_IN_am.v' || l_linenumber AS field, 'row' || l_partkey % 12 || '_clock_in_am' AS key FROM lineitem",
    "bucket_fields": f"SELECT k, count(*)::BIGINT AS n, {_BUCKET.format('lower(k)')} AS bucket, {_TYPE.format('k')} AS ftype, split_part(k, '_r', 1) AS cls FROM (SELECT {samples.KEY} AS k FROM lineitem) GROUP BY k",
    "nbest_rescore": f"SELECT o_orderkey, pos::BIGINT AS pos, cand, round(s, 6) AS score, CASE WHEN bits = '' THEN 'ok' ELSE bits END AS note, row_number() OVER (PARTITION BY o_orderkey ORDER BY s DESC, length(norm), pos)::BIGINT AS rank FROM ({_SCORED})",
    "local_choice": f"""SELECT o_orderkey, raw, coalesce(nullif(san, ''), compact) AS sanitized, round(t, 6) AS total FROM (SELECT *, logp + CASE WHEN san IS NOT NULL THEN 1 ELSE 0 END - CASE WHEN compact LIKE '%..%' OR compact LIKE '%,,%' THEN 0.5 ELSE 0 END
      - CASE WHEN regexp_matches(compact, '[A-Za-z]') THEN 0.5 ELSE 0 END AS t FROM ({_LOCAL})) QUALIFY row_number() OVER (PARTITION BY o_orderkey ORDER BY t DESC, pos) = 1""",
    "triage_conf": rf"""SELECT o_orderkey, round(conf, 4) AS conf, coalesce(san, pred) AS clean, (san IS NOT NULL)::INT AS sanitized, v::INT AS valid, round(f, 4) AS final_conf, (f < 0.6 OR NOT v)::INT AS needs_review
      FROM (SELECT *, san IS NOT NULL AND regexp_matches(coalesce(san, ''), '^\$?\d{{1,3}}(?:,\d{{3}})*(?:\.\d{{2}})$') AS v, least(greatest(conf + CASE WHEN san IS NOT NULL THEN 0.15::DOUBLE ELSE 0 END + CASE WHEN v THEN 0.15::DOUBLE ELSE 0 END, 0), 0.99::DOUBLE) AS f FROM ({_TRIAGE}))""",
    "cer_exact_match": "SELECT p_brand, count(*)::BIGINT AS n, round(sum((pred = p_name)::INT) / count(*), 6) AS em, round(sum(levenshtein(pred, p_name)) / sum(length(p_name)), 6) AS cer FROM (SELECT *, CASE WHEN p_partkey % 3 = 0 THEN p_name ELSE replace(replace(p_name, 'a', 'o'), 'e', '') END AS pred FROM part) GROUP BY p_brand",
    "accuracy_report": f"SELECT count(*)::BIGINT AS total, count_if(tag = 'OK')::BIGINT AS exact, round(coalesce(avg((tag = 'OK')::INT), 0), 6) AS rate, count_if(tag = 'INVALID_PRED')::BIGINT AS invalid_pred FROM ({_TAGS})",
    "confusion_topk": f"SELECT gt_time, pred_time, count(*)::BIGINT AS n FROM ({_TAGS}) WHERE tag = 'MISMATCH' GROUP BY ALL ORDER BY n DESC, gt_time, pred_time LIMIT 10",
    "eval_per_column": _eval(),
    "labels_latest": _LATEST,
    "labels_latest_stream": _LATEST,
    "labels_gold": f"SELECT crop_path, coalesce(t, label) AS text FROM ({strict(_GOLD, 'label', 't')})",
    "missing_images": "SELECT o_orderkey, o_orderstatus FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem WHERE l_quantity > 25)",
    "grid_row_bin": f"SELECT l_orderkey, l_linenumber, {_ROW} AS row_tops, CASE WHEN abs(({q._CY})::DOUBLE - 510 - 120 * ({_MID} + 0.5::DOUBLE)) <= 66 THEN {_MID}::INT END AS row_centered FROM lineitem",
    "row_histogram": f"SELECT r::INT AS row_idx, count(cy)::BIGINT AS n, min(cy) AS y_min, max(cy) AS y_max FROM (SELECT unnest(range(12)) AS r) LEFT JOIN (SELECT {_ROW} AS slot, cast({q._CY} AS double) AS cy FROM lineitem) ON r = slot GROUP BY r",
    "grid_assign": f"""SELECT page_id, row_idx, c.col_idx, det_idx, c.name FROM ({_DET}) d JOIN ({_CENTERS}) c ON c.col_idx = d.det_idx - 1 WHERE cls <> 'date'""",
    "layout_offsets": f"SELECT r::INT AS row_idx, col_idx, name, x0::INT AS x0, floor(x0 + width / 2)::INT AS x_center, (510 + r * 120)::INT AS y0 FROM ({_OFFSETS}), (SELECT unnest(range(12)) AS r)",
    "coco_annotations": _COCO,
    "coco_images": f"SELECT DISTINCT {_NUMBER} AS id, page_image AS file_name, 0 AS width, 0 AS height FROM ({_TYPED}) WHERE cid < 8",
    "yolo_lines": f"SELECT page_image, pos, printf('%d %.6f %.6f %.6f %.6f', cid, (x + w / 2.0::DOUBLE) / 1700, (y + h / 2.0::DOUBLE) / 2200, w / 1700.0::DOUBLE, h / 2200.0::DOUBLE) AS line FROM ({_TYPED})",
    "crop_manifest": f"""SELECT page_image AS image_id, field_name, bucket, page_image || '/' || bucket || '/' || field_name || '.png' AS crop_path, concat_ws(',', greatest(x - 6, 0), greatest(y - 6, 0), least(x + w + 6, 1700), least(y + h + 6, 2200)) AS bbox, count(*)::BIGINT AS n
      FROM (SELECT *, {_BUCKET.format('field_name')} AS bucket FROM ({_FIELDS})) GROUP BY ALL""",
    "bbox_any": f"SELECT l_orderkey, l_linenumber, array_to_string({_CORNERS}, ',') AS bbox FROM lineitem",
    "dataset_lint": f"SELECT split, count(*)::BIGINT AS n, count_if(NOT here)::BIGINT AS missing, count_if(contains(raw, ':') AND t IS DISTINCT FROM raw)::BIGINT AS bad_time, count_if(NOT contains(raw, ':') AND m IS DISTINCT FROM raw)::BIGINT AS bad_amount FROM ({_LINT}) GROUP BY split",
    "split_exact": "SELECT o_orderkey, CASE WHEN row_number() OVER (ORDER BY md5('13|' || o_orderkey)) <= greatest(1, floor(0.15 * count(*) OVER ())) THEN 'val' ELSE 'train' END AS split FROM orders",
    "failure_reasons": f"SELECT Warnings[1] AS Reason, count(*)::BIGINT AS n FROM ({_FAILED}) GROUP BY 1 ORDER BY n DESC, Reason LIMIT 10",
    "failure_texts": f"SELECT CleanText, count(*)::BIGINT AS n FROM ({_FAILED}) WHERE CleanText IS NOT NULL GROUP BY 1 ORDER BY n DESC, CleanText LIMIT 15",
    "union_inputs": "SELECT c_name AS text, c_mktsegment AS field_type, NULL::BIGINT AS page FROM customer UNION ALL SELECT s_name, NULL, s_nationkey FROM supplier",
    "text_clean": r"""SELECT conv_id, turn, replace(replace(replace(replace(replace(trim(regexp_replace(coalesce(text, ''), '\s+', ' ', 'g')), '&', '&amp;'), '<', '&lt;'), '>', '&gt;'), '"', '&quot;'), '''', '&#x27;') AS text FROM conversations""",
    "label_import": f"""SELECT ftype, count(*)::BIGINT AS fields, count(v)::BIGINT AS with_text, sum(CASE WHEN p[3] > p[1] AND p[4] > p[2] THEN p[3] - p[1] ELSE 0 END)::BIGINT AS width FROM (SELECT ftype, {_PAD('b')} AS p,
      CASE WHEN trim(value) IN ('', '<EMPTY>', '<ILLEGIBLE>', '<SIGNATURE>', 'NA', 'N/A') THEN NULL WHEN ftype = 'time' THEN t WHEN ftype = 'amount' THEN m ELSE trim(value) END AS v FROM ({_IMPORT})) GROUP BY ftype""",
    "events_by_hour": "SELECT strftime(date_trunc('hour', ts), '%Y-%m-%d %H:%M') AS hour, event_type, count(*)::BIGINT AS n FROM events GROUP BY ALL",
}
