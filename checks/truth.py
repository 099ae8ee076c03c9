"""Expected results in DuckDB SQL, from the columns the pages were rendered of.

No statement here looks at a page: the parser and this file share nothing but
the recipe of ``fixtures/render.py``.
"""

AS_OF_MONTH = 2026 * 12  # January 2026, months counted from 0

_PRELUDE = """
WITH names AS (
  SELECT l_orderkey, list_sort(list(DISTINCT p_name)) AS names
  FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY l_orderkey
), job AS (
  SELECT o_orderkey AS n, o_orderkey // 8 AS k, (o_orderkey // 8) % 10 AS v,
    row_number() OVER (PARTITION BY o_orderkey // 8 ORDER BY o_orderkey) - 1 AS pos,
    o_custkey, o_orderdate, o_orderpriority AS prio, o_orderstatus AS status,
    regexp_replace(o_orderpriority, '^[0-9]-', '') AS role,
    coalesce(names, CAST([] AS VARCHAR[])) AS names,
    CAST(year(o_orderdate) * 12 + month(o_orderdate) - 1 AS BIGINT) AS m0,
    CAST(year(o_orderdate) * 12 + month(o_orderdate) - 1 AS BIGINT) + o_orderkey % 36 AS m9,
    o_orderkey % 36 + 1 AS span, o_orderkey % 11 = 0 AS open,
    ['Альфа Трейд', 'Бета Логістик', 'Гамма', 'Дельта Сервіс', 'Омега'][o_orderkey % 5 + 1] AS company,
    ['Київ', 'Львів', 'Одеса', 'Біла Церква'][(o_orderkey // 2) % 4 + 1] AS town,
    ['Логістика', 'Торгівля', 'Автобізнес'][o_orderkey % 3 + 1] AS industry,
    ['Київська обл.', 'Львівська обл.'][o_orderkey % 2 + 1] AS region
  FROM orders LEFT JOIN names ON o_orderkey = l_orderkey
), job2 AS (
  SELECT *,
    CASE WHEN n % 9 = 0 THEN list_transform(names, lambda x: x || ' (етап 1, етап 2; план)') ELSE names END AS stages,
    CASE WHEN len(names) > 0 THEN names ELSE ['нема'] END AS described,
    printf('%02d.%04d', m0 % 12 + 1, m0 // 12) AS d0,
    CASE WHEN open THEN 'нині' ELSE printf('%02d.%04d', m9 % 12 + 1, m9 // 12) END AS d9,
    CASE WHEN n % 4 = 2 THEN company || ' (' || industry || ')'
         WHEN n % 4 = 3 THEN company || ', ' || town || ' (' || region || ') (' || industry || ')'
         ELSE company || ', ' || town || ' (' || industry || ')' END AS tail
  FROM job
), job3 AS (
  SELECT *,
    'з ' || d0 || ' по ' || d9 || CASE WHEN n % 6 = 5 THEN '' ELSE ' (' || span || ' міс.)' END || ' ' || tail AS dates_line,
    role || ': ' || array_to_string(described, '. ') AS role_line_a,
    'Роль ' || status || ' - ' || array_to_string(described, '; ') AS role_line_b
  FROM job2
), item0 AS (
  SELECT k, v, n, pos, sub,
    CASE WHEN v = 7 AND sub = 0 THEN role WHEN v = 7 THEN 'Роль ' || status ELSE prio END AS title,
    CASE WHEN v = 9 THEN 'ТОВ ' || company ELSE company END AS company,
    CASE WHEN v >= 8 OR n % 4 = 2 THEN NULL WHEN n % 4 = 3 THEN region ELSE town END AS city,
    CASE WHEN v = 9 THEN NULL ELSE industry END AS industry,
    CASE WHEN v = 8 THEN (m0 // 12) || '-01'
         WHEN v = 9 AND n % 13 = 0 AND NOT open THEN printf('19%02d-%02d', (m0 // 12) % 100, m0 % 12 + 1)
         ELSE printf('%04d-%02d', m0 // 12, m0 % 12 + 1) END AS "start",
    CASE WHEN open THEN 'present' WHEN v = 8 THEN (m0 // 12 + n % 3) || '-12'
         ELSE printf('%04d-%02d', m9 // 12, m9 % 12 + 1) END AS "end",
    CAST(CASE WHEN v = 9 THEN 0
         WHEN v = 8 AND open THEN 24312 - (m0 // 12) * 12 + 1
         WHEN v = 8 THEN (n % 3 + 1) * 12
         WHEN open THEN 24312 - m0 + 1 ELSE span END AS BIGINT) AS months,
    CASE WHEN v = 7 THEN described WHEN v = 8 THEN names WHEN v = 9 THEN CAST([] AS VARCHAR[])
         ELSE stages END AS duties,
    CASE WHEN v = 7 AND sub = 0 THEN array_to_string(described, '. ')
         WHEN v = 7 THEN array_to_string(described, '; ')
         WHEN v = 8 THEN array_to_string(names, ' ') WHEN v = 9 THEN ''
         ELSE array_to_string(stages, ', ') END AS duties_text
  FROM job3, (VALUES (0), (1)) AS s(sub) WHERE sub = 0 OR v = 7
), item AS (
  SELECT *, row_number() OVER (PARTITION BY k ORDER BY pos, sub) - 1 AS item_no
  FROM item0 WHERE k % 50 <> 0
), block AS (
  SELECT k, pos AS block_no, n, status, role, described, company, industry, tail, dates_line, v,
    CASE WHEN v = 7 THEN 'Роль ' || status || ' / ' || role ELSE prio END AS title,
    CASE WHEN v = 7 THEN role_line_a || ' ' || role_line_b ELSE array_to_string(stages, ', ') END AS duties_text
  FROM job3 WHERE v <= 7 AND k % 50 <> 0
), head AS (
  SELECT k, arg_min(o_custkey, n) AS custkey, CAST(max(o_orderdate) AS DATE) AS day FROM job GROUP BY k
), person AS (
  SELECT k, day, c_name, c_mktsegment AS segment, n_name, abs(CAST(trunc(c_acctbal * 10) AS INTEGER)) AS amount,
    CASE WHEN k % 3 = 0 THEN ['Англійська', 'Польська', 'Німецька', 'Французька', 'Іспанська'][k % 5 + 1] || ' — середній'
         WHEN k % 3 = 1 THEN ['Англійська', 'Польська', 'Німецька', 'Французька', 'Іспанська'][k % 5 + 1] || ' upper intermediate'
         ELSE ['Англійська', 'Польська', 'Німецька', 'Французька', 'Іспанська'][k % 5 + 1] || ': вільно' END AS spoken
  FROM head JOIN customer ON custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
  WHERE k % 50 <> 0
), early AS (
  SELECT k, x AS name FROM job, unnest(names) AS u(x) WHERE pos < 3 AND k % 50 <> 0 GROUP BY k, x
), skill AS (
  SELECT k, list_transform(coalesce(list(name ORDER BY name), CAST([] AS VARCHAR[])),
           lambda x: CASE WHEN k % 2 = 0 THEN upper(x) ELSE x END) AS found
  FROM early GROUP BY k
), skills AS (
  SELECT p.k, coalesce(found, CAST([] AS VARCHAR[]))
     || CASE WHEN p.k % 5 = 0 THEN ['Водій кат. B', 'CE'] ELSE CAST([] AS VARCHAR[]) END AS skills
  FROM person p LEFT JOIN skill s ON p.k = s.k
), study AS (
  SELECT k, 'КНТУ фак. Економіка, Київ, ' || ['незакінчена вища', 'вища', 'середня спеціальна', 'середня'][k % 4 + 1]
    || ', з ' || (1970 + k % 25) || ' по ' || (1970 + k % 25 + k % 6) || ' (' || (k % 6 + 1) || ' р.)' AS line
  FROM person
), work_text AS (
  SELECT k, string_agg(CASE
      WHEN v = 7 THEN 'Роль ' || status || ' / ' || role || chr(10) || dates_line || chr(10) || role_line_a || chr(10) || role_line_b
      WHEN v = 8 THEN prio || ' (' || (m0 // 12) || ' – ' || CASE WHEN open THEN 'нині' ELSE CAST(m0 // 12 + n % 3 AS VARCHAR) END
        || ') ' || company || ' (' || industry || ')'
        || CASE WHEN len(names) > 0 THEN chr(10) || array_to_string(names, ', ') ELSE '' END
      WHEN v = 9 THEN 'з 01.' || printf('%02d', m0 % 12 + 1) || '.'
        || CASE WHEN n % 13 = 0 AND NOT open THEN printf('%02d', (m0 // 12) % 100) ELSE CAST(m0 // 12 AS VARCHAR) END
        || ' по ' || CASE WHEN open THEN 'нині' ELSE '28.' || d9 END || ' - ' || prio || ', ТОВ ' || company
      ELSE prio || chr(10) || dates_line || CASE WHEN len(names) > 0 THEN chr(10) || array_to_string(stages, ', ') ELSE '' END
    END, chr(10) ORDER BY pos) AS work_experience
  FROM job3 GROUP BY k
), sections AS (
  SELECT p.k, w.work_experience,
    CASE p.k % 3 WHEN 1 THEN 'Національний університет Харків' || chr(10) || 'Право' || chr(10) || line || chr(10) || 'Диплом'
      WHEN 2 THEN 'Перший інститут' || chr(10) || 'Фізика' || chr(10) || 'Хімія' || chr(10) || 'Другий університет' || chr(10) || line
      ELSE line END AS education,
    CASE WHEN p.k % 8 = 1 THEN 'Курси Excel ' || (p.k % 9) END AS additional_education,
    CASE WHEN len(s.skills) > 0 THEN array_to_string(s.skills, '|') END AS skills,
    spoken || CASE WHEN p.k % 2 = 0 THEN '|Українська вільно' ELSE '' END AS languages,
    CASE WHEN p.k % 6 = 2 THEN 'Керівник ' || (p.k % 3) END AS recommendations,
    CASE WHEN p.k % 3 = 1 THEN 'Стаж ' || (p.k % 20) || ' & ветеран праці' END AS additional_info,
    CASE WHEN p.k % 6 = 0 THEN 'III група' END AS disability
  FROM person p JOIN skills s ON p.k = s.k JOIN study t ON p.k = t.k JOIN work_text w ON p.k = w.k
), duty AS (
  SELECT k, item_no, months, d AS duty FROM item, unnest(duties) AS u(d)
), known AS (
  SELECT DISTINCT k, lower(x) AS name FROM skills, unnest(skills) AS u(x)
), skill_sum AS (
  SELECT d.k, d.duty AS skill, CAST(sum(months) AS BIGINT) AS skill_months
  FROM duty d JOIN known s ON d.k = s.k AND d.duty = s.name WHERE months > 0 GROUP BY d.k, d.duty
), title_sum AS (
  SELECT k, lower(title) AS position, arg_min(title, item_no) AS display_position,
    CAST(sum(months) AS BIGINT) AS months, min(item_no) AS first_item_no
  FROM item WHERE months > 0 GROUP BY k, lower(title)
), edu AS (
  SELECT k, 0 AS item_no, 'Перший інститут' AS place, '' AS degree, 'Фізика' AS specialty, CAST(NULL AS VARCHAR) AS "start",
    CAST(NULL AS VARCHAR) AS "end", CAST(NULL AS BIGINT) AS months, 'Хімія' AS extra FROM person WHERE k % 3 = 2
  UNION ALL
  SELECT k, CASE WHEN k % 3 = 2 THEN 1 ELSE 0 END, 'КНТУ', ['незакінчена вища', 'вища', 'середня спеціальна', 'середня'][k % 4 + 1],
    'Економіка', (1970 + k % 25) || '-01', (1970 + k % 25 + k % 6) || '-12', (k % 6 + 1) * 12,
    '(' || (k % 6 + 1) || ' р.)' || CASE WHEN k % 3 = 1 THEN ' Диплом' ELSE '' END
  FROM person
), category AS (
  SELECT k, CASE WHEN k % 5 = 0 THEN 'B|CE' ELSE '' END AS categories FROM person
)
"""


def truth(select: str) -> str:
    return _PRELUDE + select


AMOUNT = "CASE WHEN amount >= 1000 THEN (amount // 1000) || ' ' || printf('%03d', amount % 1000) ELSE CAST(amount AS VARCHAR) END"
# a tail needs three characters of digits and spaces before the currency: two digits and the space
POSITION = f"CASE WHEN amount >= 10 THEN segment ELSE segment || ', ' || amount || ' грн' END"
SALARY = "CASE WHEN amount BETWEEN 1000 AND 1000000 THEN CAST(amount AS BIGINT) END"
YEARS = "CASE WHEN {m} > 0 THEN round_even({m} / 12.0, 1) END"


def years(column: str) -> str:
    return YEARS.format(m=column)


# --------------------------------------------------------------------------
# the cleaning chain on the given pages, step by step as in functions/text.py
# --------------------------------------------------------------------------
_INVISIBLE = (
    r"(?is)<!--.*?-->|<script(?:\s[^>]*)?>.*?</script\s*>"
    r"|<style(?:\s[^>]*)?>.*?</style\s*>|<noscript(?:\s[^>]*)?>.*?</noscript\s*>"
)
CLEAN = rf"""
WITH shown AS (
  SELECT page_id, url, regexp_replace(regexp_replace(html, '\r\n?', chr(10), 'g'), '{_INVISIBLE}', '<!>', 'g') AS h FROM pages
), parts AS (
  SELECT page_id, url, string_split(regexp_replace(
    regexp_replace(regexp_replace(h, '(?i)</article>', '</p>', 'g'),  -- what holds an open paragraph ends it
      '(?i)(<li(?:\s[^>]*)?>)\s*<(?:p|h[1-4])(?:\s[^>]*)?>', '\1', 'g'),
    '(?i)(</?(?:p|li|h[1-4]|dt|dd)(?:\s[^>]*|/)?>)', chr(1) || '\1', 'g'), chr(1)) AS parts
  FROM shown
), piece AS (
  SELECT page_id, url, i, CASE WHEN i = 1 THEN '' ELSE lower(regexp_extract(p, '^<(/?[a-zA-Z0-9]+)', 1)) END AS tag,
    CASE WHEN i = 1 THEN p ELSE substr(p, instr(p, '>') + 1) END AS rest
  FROM (SELECT page_id, url, unnest(parts) AS p, generate_subscripts(parts, 1) AS i FROM parts)
), bare AS (
  SELECT page_id, url, i, tag, trim(regexp_replace(rest, '<[^>]*>',
    CASE WHEN tag IN ('p', 'li', 'h1', 'h2', 'h3', 'h4', 'dt', 'dd') THEN ' ' ELSE chr(10) END, 'g'), ' ' || chr(9) || chr(10)) AS t
  FROM piece
), joined AS (
  SELECT page_id, url, string_agg(CASE
      WHEN tag = 'dt' THEN chr(10) || rtrim(t, ':') || ':'
      WHEN t = '' THEN CASE WHEN tag = '/dt' THEN '' ELSE chr(10) END
      WHEN tag = 'dd' THEN ' ' || t || chr(10)
      WHEN tag = 'li' THEN chr(10) || '• ' || t || chr(10)
      WHEN tag IN ('h1', 'h2', 'h3', 'h4') THEN chr(10) || chr(10) || t || chr(10)
      ELSE chr(10) || t || chr(10) END, '' ORDER BY i) AS t
  FROM bare GROUP BY page_id, url
), decoded AS (
  SELECT page_id, url, replace(replace(replace(replace(replace(replace(replace(t, '&copy;', '©'), '&middot;', '·'),
    '&quot;', '"'), '&lt;', '<'), '&gt;', '>'), '&nbsp;', chr(160)), '&amp;', '&') AS t FROM joined
), cleaned AS (
  SELECT page_id, url, trim(regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(
    replace(replace(t, chr(160), ' '), chr(8203), ''),
    '[ \t]{{2,}}', ' ', 'g'), '[ \t]?\n[ \t]?', chr(10), 'g'), '\n{{3,}}', chr(10) || chr(10), 'g'),
    '\n•[ \t\n]*\n', chr(10), 'g'), '(?m)^OK$\n?', '', 'g'), ' ' || chr(9) || chr(10)) AS cleaned_text
  FROM decoded
)
"""

LINKS = rf"""
WITH href AS (
  SELECT page_id, unnest(hs) AS h, generate_subscripts(hs, 1) AS i FROM (
    SELECT page_id, regexp_extract_all(regexp_replace(html, '{_INVISIBLE}', '<!>', 'g'),
      '(?is)<a\s(?:[^>]*?\s)?href\s*=\s*"(.*?)"', 1) AS hs FROM pages)
), absolute AS (
  SELECT page_id, i, replace(replace(replace(replace(CASE WHEN regexp_matches(h, '^https?://') THEN h
    ELSE 'http://site.example/' || ltrim(h, '/') END, '&copy;', '©'), '&middot;', '·'), '&quot;', '"'), '&amp;', '&') AS url
  FROM href
), link AS (
  SELECT page_id AS list_page, url, row_number() OVER (PARTITION BY page_id ORDER BY min(i)) - 1 AS pos
  FROM absolute WHERE url <> 'http://site.example/' GROUP BY page_id, url
)
"""
