"""DuckDB SQL with the same results as each query, written independently."""

from __future__ import annotations

import re

from hirelake.functions.roles import GROUP_PHRASES, ROLES
from hirelake.functions.salary_freeform import NO_NUMBER_PHRASES
from hirelake.functions.seniority import LEVEL_PHRASES
from hirelake.functions.skills import SKILLS
from verification.fixture import postings_oracle

SPACES = r"[\s\x{0b}\x{1c}-\x{1f}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]+"
ROW = "job_id, source_page, position, CAST(scraped_at AS VARCHAR) AS scraped_at"
LAST = "scraped_at DESC, source_page DESC, position DESC"


def quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def squeezed(sql: str) -> str:
    return f"trim(regexp_replace({sql}, '{SPACES}', ' ', 'g'))"


def stripped(sql: str) -> str:
    return f"regexp_replace({sql}, '^{SPACES}|{SPACES}$', '', 'g')"


def phrase_words(sql: str) -> str:
    return rf"(' ' || trim(regexp_replace(lower({sql}), '[^\p{{L}}\p{{N}}\p{{M}}+#]+', ' ', 'g')) || ' ')"


def values(rows: list[tuple], names: str, alias: str) -> str:
    body = ", ".join("(" + ", ".join(quoted(v) if isinstance(v, str) else str(v) for v in r) + ")" for r in rows)
    return f"(VALUES {body}) AS {alias}({names})"


ROLE_VALUES = values([(p, r.name, r.group, i) for i, r in enumerate(ROLES) for p in r.phrases], "phrase, role, grp, prio", "v")
HINT_VALUES = values([(p, g, i) for i, (g, ps) in enumerate(GROUP_PHRASES.items()) for p in ps], "phrase, grp, prio", "v")
LEVEL_VALUES = values([(p, lv, i) for i, (lv, ps) in enumerate(LEVEL_PHRASES.items()) for p in ps], "phrase, lvl, prio", "v")
SKILL_MAP = "MAP {" + ", ".join(f"{quoted(k)}: {quoted(v)}" for k, v in SKILLS.items()) + "}"
PHRASE_LIST = "(" + ", ".join(sorted({quoted(p.lower().rstrip(" !.")) for p in NO_NUMBER_PHRASES})) + ")"

CTES: dict[str, str] = {}
NEEDS: dict[str, list[str]] = {}


def cte(name: str, needs: list[str], sql: str) -> None:
    CTES[name], NEEDS[name] = sql, needs


def with_ctes(needs: list[str], sql: str) -> str:
    ordered: list[str] = []

    def visit(name: str) -> None:
        for n in NEEDS[name]:
            visit(n)
        if name not in ordered:
            ordered.append(name)

    for n in needs:
        visit(n)
    if not ordered:
        return sql
    return "WITH " + ",\n".join(f"{n} AS MATERIALIZED (\n{CTES[n]}\n)" for n in ordered) + "\n" + sql


cte("postings", [], postings_oracle())
cte("latest", ["postings"], f"SELECT * FROM postings QUALIFY row_number() OVER (PARTITION BY job_id ORDER BY {LAST}) = 1")

# --- token salaries: parsed once per distinct text ---------------------------
cte("token_split", ["postings"], f"""
SELECT salary, list_filter(string_split({squeezed("replace(translate(lower(salary), '–—', '--'), '-', ' - ')")}, ' '), lambda w: w <> '') AS t
FROM (SELECT DISTINCT salary FROM postings)""")
cte("token_kind", ["token_split"], """
SELECT salary, t, len(t) AS n, coalesce(list_position(t, '-'), 0) AS d,
  CASE WHEN salary IS NULL OR len(t) = 0 THEN 'empty'
       WHEN t[1] IN ('thoả', 'thỏa') AND t[2] = 'thuận' THEN 'negotiable'
       WHEN t[1] = 'tới' THEN 'maximum' WHEN t[1] = 'từ' THEN 'minimum'
       WHEN list_contains(t, '-') THEN 'range' ELSE 'other' END AS kind
FROM token_split""")
cte("token_picked", ["token_kind"], """
SELECT *, CASE WHEN kind = 'range' THEN d >= 2 AND d + 2 <= n ELSE n >= 3 END AS complete,
  CASE WHEN kind = 'range' THEN t[d + 2] ELSE t[3] END AS unit,
  CASE WHEN kind = 'range' THEN CASE WHEN d >= 2 THEN t[d - 1] END ELSE t[2] END AS low_text,
  CASE WHEN kind = 'range' THEN t[d + 1] ELSE t[2] END AS high_text
FROM token_kind""")
_NUM = "CASE WHEN regexp_full_match({0}, '[+]?([0-9]+[.]?[0-9]*|[.][0-9]+)') THEN TRY_CAST({0} AS DOUBLE) END"
_DIG = "CASE WHEN unit = 'usd' THEN replace({0}, ',', '') ELSE replace({0}, ',', '.') END"
cte("token_number", ["token_picked"], f"""
SELECT *, {_NUM.format('lo')} AS low, {_NUM.format('hi')} AS high,
  CASE WHEN unit IN ('triệu', 'tr') THEN 'VND' WHEN unit = 'usd' THEN 'USD' END AS cur,
  CASE WHEN unit IN ('triệu', 'tr') THEN 1e6 WHEN unit = 'usd' THEN 1.0 END AS factor
FROM (SELECT *, {_DIG.format('low_text')} AS lo, {_DIG.format('high_text')} AS hi FROM token_picked)""")
cte("token_error", ["token_number"], """
SELECT *, CASE WHEN kind = 'negotiable' THEN NULL WHEN kind = 'empty' THEN 'empty_salary'
  WHEN kind = 'other' THEN 'unsupported_format' WHEN NOT complete THEN 'missing_number_or_unit'
  WHEN cur IS NULL THEN 'unsupported_unit:' || unit WHEN low IS NULL OR high IS NULL THEN 'invalid_number'
  WHEN low > high THEN 'min_greater_than_max' END AS err FROM token_number""")
cte("token_salary", ["token_error"], """
SELECT salary AS salary_text,
  CASE WHEN err IS NULL AND kind <> 'negotiable' THEN low * factor END AS salary_min,
  CASE WHEN err IS NULL AND kind IN ('range', 'maximum') THEN high * factor END AS salary_max,
  CASE WHEN (err IS NULL AND kind <> 'negotiable') OR err = 'min_greater_than_max' THEN cur END AS salary_currency,
  CAST(NULL AS VARCHAR) AS salary_period,
  CASE WHEN kind IN ('empty', 'other') THEN 'unknown' ELSE kind END AS salary_type,
  CASE WHEN err IS NULL THEN 'success' WHEN err = 'min_greater_than_max' THEN 'invalid' ELSE 'unparsed' END AS salary_parse_status,
  'salary_parser_v4' AS salary_parser_version, err AS salary_parse_error
FROM token_error""")
cte("with_salary", ["postings", "token_salary"],
    "SELECT p.*, s.* FROM postings p JOIN token_salary s ON p.salary IS NOT DISTINCT FROM s.salary_text")

# --- free-form salaries ------------------------------------------------------
_CUR = r"\$|usd|vnđ|vnd|đồng|đ"
_AMT = rf"({_CUR})? ?([0-9]+(?:[.,][0-9]+)*) ?(m|triệu|tr)? ?({_CUR})?"
cte("free_plain", ["postings"], f"""
SELECT salary_freeform AS raw, {squeezed("replace(translate(lower(salary_freeform), '–—', '--'), '’', '''')")} AS p
FROM (SELECT DISTINCT salary_freeform FROM postings)""")
cte("free_core", ["free_plain"], rf"""
SELECT raw, p,
  CASE WHEN regexp_matches(p, '(/ ?month|per month|/ ?tháng|mỗi tháng)') THEN 'month'
       WHEN regexp_matches(p, '(/ ?year|per year|mỗi năm)') THEN 'year' END AS per,
  {squeezed(r"regexp_replace(regexp_replace(regexp_replace(p, '/ ?month|per month|/ ?tháng|mỗi tháng|/ ?year|per year|mỗi năm', ' ', 'g'), '[()]|, |,$', ' ', 'g'), '\b(negotiable|negotiation|negotiated|approximately|gross|net|salary|package|or)\b|hoặc|th[ỏo][ảa] thuận|thương lượng|theo năng lực', '', 'g')")} AS core
FROM free_plain""")
cte("free_groups", ["free_core"], rf"""
SELECT raw, p, per, core,
  regexp_extract(core, '^(up to|upto|up|đến|tối đa|from|từ|ít nhất|tối thiểu)? ?{_AMT}(?: ?(-|đến|to) ?(?:up to|upto|up|đến|tối đa)? ?{_AMT})?$',
    ['w', 'a1', 'n1', 'm1', 'b1', 'dash', 'a2', 'n2', 'm2', 'b2']) AS g
FROM free_core""")
_READ = (
    "CASE WHEN regexp_full_match({0}, '[0-9]{{1,3}}([.,][0-9]{{3}})+') THEN TRY_CAST(translate({0}, '.,', '') AS DOUBLE) "
    "WHEN regexp_full_match({0}, '[0-9]+([.,][0-9]{{1,2}})?') THEN TRY_CAST(replace({0}, ',', '.') AS DOUBLE) END"
)
_UNIT = (
    "CASE WHEN ({0} IN ('$', 'usd') OR {2} IN ('$', 'usd')) THEN CASE WHEN {1} <> '' OR {0} IN ('vnd', 'vnđ', 'đ', 'đồng') "
    "OR {2} IN ('vnd', 'vnđ', 'đ', 'đồng') THEN 'conflict' ELSE 'USD' END WHEN {0} || {1} || {2} <> '' THEN 'VND' ELSE '' END"
)
cte("free_values", ["free_groups"], f"""
SELECT raw, p, per, g.w AS w, g.n1 <> '' AS matched, g.n2 <> '' AS is_range, g.m1 AS m1, g.m2 AS m2,
  {_READ.format('g.n1')} AS v1, {_READ.format('g.n2')} AS v2,
  {_UNIT.format('g.a1', 'g.m1', 'g.b1')} AS c1, {_UNIT.format('g.a2', 'g.m2', 'g.b2')} AS c2
FROM free_groups""")
cte("free_scaled", ["free_values"], """
SELECT *,
  CASE WHEN m1 <> '' OR (c1 = '' AND m2 <> '' AND v1 < 1e6) THEN v1 * 1e6 ELSE v1 END AS x1,
  CASE WHEN m2 <> '' OR (c2 = '' AND m1 <> '' AND v2 < 1e6) THEN v2 * 1e6 ELSE v2 END AS x2,
  CASE WHEN NOT is_range THEN CASE WHEN c1 = '' THEN CASE WHEN v1 >= 1e6 THEN 'VND' END WHEN c1 <> 'conflict' THEN c1 END
       WHEN c1 = 'conflict' OR c2 = 'conflict' THEN NULL
       WHEN c1 = '' AND c2 = '' THEN CASE WHEN least(v1, v2) >= 1e6 THEN 'VND' END
       WHEN c1 = '' THEN c2 WHEN c2 = '' OR c1 = c2 THEN c1 END AS cur
FROM free_values""")
cte("free_salary", ["free_scaled"], f"""
SELECT raw AS free_text,
  CASE WHEN ok AND NOT (max_only AND NOT is_range) THEN x1 END AS min_salary,
  CASE WHEN ok AND is_range THEN x2 WHEN ok AND w NOT IN ('from', 'từ', 'ít nhất', 'tối thiểu') THEN x1 END AS max_salary,
  CASE WHEN ok THEN cur END AS currency, CASE WHEN ok THEN per END AS period,
  CASE WHEN ok OR regexp_replace(p, '[ !.]+$', '') IN {PHRASE_LIST} THEN 'success' ELSE 'failed' END AS parse_status
FROM (SELECT *, w IN ('up to', 'upto', 'up', 'đến', 'tối đa') AS max_only,
        coalesce(matched AND v1 IS NOT NULL AND cur IS NOT NULL
          AND (NOT is_range OR (w NOT IN ('up to', 'upto', 'up', 'đến', 'tối đa') AND x1 <= x2)), false) AS ok FROM free_scaled)""")

# --- classification ----------------------------------------------------------
cte("years", ["postings"], r"""
SELECT experience AS exp_text, CASE
  WHEN e LIKE '%không yêu cầu%' THEN 0.0
  WHEN r.b <> '' THEN (CAST(replace(r.a, ',', '.') AS DOUBLE) + CAST(replace(r.b, ',', '.') AS DOUBLE)) / 2
  WHEN m.b <> '' THEN floor((CAST(replace(m.a, ',', '.') AS DOUBLE) + CAST(m.b AS DOUBLE) / 12) * 2 + 0.5) / 2
  WHEN s.a <> '' AND e LIKE '%trên %' THEN CAST(replace(s.a, ',', '.') AS DOUBLE) + 0.5
  WHEN s.a <> '' AND e LIKE '%dưới %' THEN greatest(0.0, CAST(replace(s.a, ',', '.') AS DOUBLE) - 0.5)
  WHEN s.a <> '' THEN CAST(replace(s.a, ',', '.') AS DOUBLE) END AS years
FROM (SELECT experience, e,
    regexp_extract(e, '([0-9]+(?:[.,][0-9]+)?) ?(?:năm )?(?:-|đến) ?([0-9]+(?:[.,][0-9]+)?) ?năm', ['a', 'b']) AS r,
    regexp_extract(e, '([0-9]+(?:[.,][0-9]+)?) ?năm ([0-9]+) tháng', ['a', 'b']) AS m,
    regexp_extract(e, '([0-9]+(?:[.,][0-9]+)?) ?năm', ['a']) AS s
  FROM (SELECT experience, lower(trim(experience)) AS e FROM (SELECT DISTINCT experience FROM postings)))""")
cte("title_words", ["postings"], f"""
SELECT title, {phrase_words('title')} AS padded FROM (SELECT DISTINCT title FROM postings)""")
cte("title_roles", ["title_words"], f"""
SELECT title, list(role ORDER BY prio) AS roles FROM (
  SELECT title, role, min(prio) AS prio FROM title_words JOIN {ROLE_VALUES} ON contains(padded, ' ' || phrase || ' ') GROUP BY ALL)
GROUP BY title""")
cte("title_hint", ["title_words"], f"""
SELECT title, arg_min(grp, prio) AS hint FROM title_words JOIN {HINT_VALUES} ON contains(padded, ' ' || phrase || ' ') GROUP BY title""")
cte("title_level", ["title_words"], f"""
SELECT title, arg_min(lvl, prio) AS lvl FROM title_words JOIN {LEVEL_VALUES} ON contains(padded, ' ' || phrase || ' ') GROUP BY title""")
cte("tag_sets", ["postings"], f"""
SELECT remaining_tags, visible_tags,
  list_filter(list_transform(coalesce(string_split(remaining_tags, ','), []), lambda x: {stripped('x')}), lambda x: x <> '') AS rem,
  list_filter(list_transform(visible_tags, lambda x: {stripped('x')}), lambda x: x <> '') AS vis
FROM (SELECT DISTINCT remaining_tags, visible_tags FROM postings)""")
cte("tag_words", ["tag_sets"], f"""
SELECT DISTINCT tag, {phrase_words('tag')} AS padded FROM (SELECT unnest(list_concat(rem, vis)) AS tag FROM tag_sets)""")
cte("tag_facts", ["tag_sets", "tag_words"], f"""
SELECT remaining_tags, visible_tags, arg_min(grp, prio) FILTER (what = 'hint') AS hint, arg_min(grp, prio) FILTER (what = 'level') AS lvl,
  list(DISTINCT prio ORDER BY prio) FILTER (what = 'role') AS role_ids
FROM (SELECT remaining_tags, visible_tags, unnest(list_concat(rem, vis)) AS tag FROM tag_sets) u
JOIN (SELECT tag, 'role' AS what, grp, prio FROM tag_words JOIN {ROLE_VALUES} ON contains(padded, ' ' || phrase || ' ')
  UNION ALL SELECT tag, 'hint', grp, prio FROM tag_words JOIN {HINT_VALUES} ON contains(padded, ' ' || phrase || ' ')
  UNION ALL SELECT tag, 'level', lvl, prio FROM tag_words JOIN {LEVEL_VALUES} ON contains(padded, ' ' || phrase || ' ')) f USING (tag)
GROUP BY ALL""")
_KEY = "trim(regexp_replace(lower({0}), '[\\s,/()|]+', ' ', 'g'))"
cte("title_skills", ["title_words"], f"""
SELECT title, list(skill ORDER BY pos, n) AS found FROM (
  SELECT title, pos, n, {SKILL_MAP}[array_to_string(w[pos:pos + n - 1], ' ')] AS skill
  FROM (SELECT title, string_split({_KEY.format('title')}, ' ') AS w FROM title_words) t,
    LATERAL (SELECT unnest(range(1, len(w) + 1)) AS pos), (VALUES (1), (2), (3)) AS k(n))
WHERE skill IS NOT NULL GROUP BY title""")
_ROLE_NAMES = "[" + ", ".join(quoted(r.name) for r in ROLES) + "]"
_GROUP_NAMES = "MAP {" + ", ".join(f"{quoted(r.name)}: {quoted(r.group)}" for r in ROLES) + "}"
cte("classified_base", ["postings", "years", "title_roles", "title_hint", "title_level", "tag_facts", "tag_sets", "title_skills"], f"""
SELECT p.*, y.years, coalesce(tr.roles, list_transform(tf.role_ids, lambda i: {_ROLE_NAMES}[i + 1]), []) AS roles,
  coalesce(th.hint, tf.hint) AS hint,
  coalesce(tl.lvl, tf.lvl, CASE WHEN years >= 5 THEN 'Senior' WHEN years >= 3 THEN 'Middle' WHEN years >= 1 THEN 'Junior'
    WHEN years >= 0 THEN 'Fresher' END, 'Unknown') AS seniority,
  list_concat(coalesce(ts.found, []), list_transform(list_concat(s.rem, s.vis), lambda x: {SKILL_MAP}[{_KEY.format('x')}])) AS mentions
FROM postings p LEFT JOIN years y ON p.experience IS NOT DISTINCT FROM y.exp_text
LEFT JOIN title_roles tr USING (title) LEFT JOIN title_hint th USING (title) LEFT JOIN title_level tl USING (title)
LEFT JOIN title_skills ts USING (title)
LEFT JOIN tag_facts tf ON p.remaining_tags IS NOT DISTINCT FROM tf.remaining_tags AND p.visible_tags IS NOT DISTINCT FROM tf.visible_tags
LEFT JOIN tag_sets s ON p.remaining_tags IS NOT DISTINCT FROM s.remaining_tags AND p.visible_tags IS NOT DISTINCT FROM s.visible_tags""")
cte("classified", ["classified_base"], f"""
SELECT * EXCLUDE (roles, hint, mentions), roles[1] AS primary_role, coalesce({_GROUP_NAMES}[roles[1]], hint) AS role_group,
  roles[2:] AS secondary, len(roles) > 1 AS is_multi_role,
  CASE WHEN len(roles) > 0 THEN 'success' WHEN hint IS NOT NULL THEN 'ambiguous' ELSE 'insufficient_information' END AS status,
  CASE WHEN len(roles) = 0 AND hint IS NULL THEN [] ELSE
    list_filter(mentions, lambda x, i: x IS NOT NULL AND list_position(mentions, x) = i) END AS skill_list
FROM classified_base""")

# With brands as further skills: the same definitions, one more lookup for tags.
_BRAND = "CASE WHEN starts_with(lower(x), 'brand#') THEN 'Brand ' || x[7:8] END"
_TAG_SKILL = f"{SKILL_MAP}[{_KEY.format('x')}]"
cte("branded_base", NEEDS["classified_base"], CTES["classified_base"].replace(_TAG_SKILL, f"coalesce({_TAG_SKILL}, {_BRAND})"))
cte("branded", ["branded_base"], CTES["classified"].replace("FROM classified_base", "FROM branded_base"))

# --- cleaned tables ----------------------------------------------------------
cte("clean_a", ["latest", "free_salary"], """
SELECT l.*, f.* FROM latest l JOIN free_salary f ON coalesce(l.salary_freeform, '') = coalesce(f.free_text, '')
QUALIFY row_number() OVER (PARTITION BY job_id ORDER BY f.free_text NULLS LAST) = 1""")
cte("latest_keys", ["latest"], "SELECT job_id AS k_job, source_page AS k_page, position AS k_pos, scraped_at AS k_at FROM latest")
cte("clean_b", ["classified", "token_salary", "latest_keys"], """
SELECT c.*, s.* FROM classified c JOIN latest_keys ON job_id = k_job AND source_page = k_page AND position = k_pos AND scraped_at = k_at
JOIN token_salary s ON c.salary IS NOT DISTINCT FROM s.salary_text""")

# --- aggregates --------------------------------------------------------------
_DE = "(lower(title) LIKE '%data engineer%' OR lower(title) LIKE '%data engineering%' OR lower(title) LIKE '%kỹ sư dữ liệu%')"
cte("g_career", ["latest"], f"SELECT count(*) AS NumberofDataEngineer FROM latest WHERE {_DE}")
cte("g_skills", ["latest"], f"""
SELECT skill, count(DISTINCT job_id) AS job_count FROM (SELECT job_id, unnest(visible_tags) AS skill FROM latest WHERE {_DE})
GROUP BY skill ORDER BY job_count DESC, skill LIMIT 10""")
cte("g_seniority", ["clean_b"], "SELECT seniority, count(*) AS total_jobs FROM clean_b WHERE seniority IS NOT NULL GROUP BY seniority")
cte("g_salary", ["latest", "token_salary"], """
SELECT avg(lo) AS LUONG_TRUNG_BINH_MIN, avg(hi) AS LUONG_TRUNG_BINH_MAX FROM (
  SELECT salary_min * 26000 AS lo, salary_max * 26000 AS hi FROM latest JOIN token_salary ON salary IS NOT DISTINCT FROM salary_text WHERE salary_currency LIKE '%USD%'
  UNION ALL
  SELECT salary_min, salary_max FROM latest JOIN token_salary ON salary IS NOT DISTINCT FROM salary_text WHERE salary_currency LIKE '%VND%')""")
cte("g_city", ["latest"], "SELECT city, count(job_id) AS TongCongViec FROM latest GROUP BY city")
cte("g_data", ["clean_b"], """
SELECT primary_role, CAST(round(CAST(avg(years) AS DECIMAL(18, 6)), 1) AS DOUBLE) AS avg_experience_years, count(*) AS total_jobs
FROM clean_b WHERE years IS NOT NULL AND primary_role IS NOT NULL AND lower(primary_role) LIKE '%data%' GROUP BY primary_role""")
cte("g_trend", ["clean_b"], "SELECT primary_role, count(primary_role) AS TongSoTuyenDung FROM clean_b GROUP BY primary_role")
GOLD = ["g_career", "g_skills", "g_seniority", "g_salary", "g_city", "g_data", "g_trend"]


def line_list(name: str, source: str, count: str, label: str, line: str, k: int | None) -> str:
    limit = f" LIMIT {k}" if k else ""
    return (
        f"SELECT {quoted(name)} AS list, coalesce(string_agg({line}, chr(10) ORDER BY i), 'Không có dữ liệu') AS text "
        f"FROM (SELECT *, row_number() OVER (ORDER BY {count} DESC, {label} NULLS FIRST) AS i FROM {source} "
        f"ORDER BY {count} DESC, {label} NULLS FIRST{limit})"
    )


_TOP = "i || '. ' || coalesce({0}, 'None') || ' — ' || {1} || ' tin'"
LISTS = [
    line_list("skills", "g_skills", "job_count", "skill", _TOP.format("skill", "job_count"), 10),
    line_list("seniority", "g_seniority", "total_jobs", "seniority", "'• ' || seniority || ': ' || total_jobs || ' tin'", None),
    line_list("cities", "g_city", "TongCongViec", "city", _TOP.format("city", "TongCongViec"), 5),
    line_list("data_roles", "g_data", "total_jobs", "primary_role",
              _TOP.format("primary_role", "total_jobs") + " || ' (KN TB: ' || format('{:.1f}', avg_experience_years) || ' năm)'", 10),
    line_list("trend", "g_trend", "TongSoTuyenDung", "primary_role", _TOP.format("primary_role", "TongSoTuyenDung"), 10),
]
cte("lists", GOLD, " UNION ALL ".join(f"({x})" for x in LISTS))

ORACLES: dict[str, str] = {}


def oracle(name: str, needs: list[str], sql: str) -> None:
    ORACLES[name] = with_ctes(needs, sql)


_ALL = f"""job_id, title, salary, experience, array_to_string(visible_tags, '|') AS visible_tags, remaining_tags, job_id_raw,
  salary_freeform, posted_at, city, company_name, job_url, source_page, position, CAST(scraped_at AS VARCHAR) AS scraped_at"""
_SMALL = """job_id, title, salary, array_to_string(visible_tags, '|') AS visible_tags, city, source_page, position,
  CAST(scraped_at AS VARCHAR) AS scraped_at"""
oracle("scan_day_snapshot", ["postings"], f"SELECT {_ALL} FROM postings")
oracle("scan_day_range", ["postings"], f"""
SELECT {_SMALL}, CAST(DATE '2024-02-27' + CAST(year(scraped_at) - 1992 AS INTEGER) AS VARCHAR) AS day FROM postings WHERE year(scraped_at) BETWEEN 1993 AND 1995""")
oracle("page_response_decode", [], """
SELECT page_id, CASE WHEN ok THEN md5(html) END AS html_md5,
  CASE WHEN ok THEN CASE WHEN k = 7 THEN 0 ELSE page_id END END AS total,
  CASE WHEN ok THEN CAST(12 AS BIGINT) END AS total_page, CASE WHEN ok THEN CAST(3 AS BIGINT) END AS current_page,
  CASE k WHEN 1 THEN 'status_not_success' WHEN 2 THEN 'data_not_an_object' WHEN 3 THEN 'html_not_a_string'
    WHEN 4 THEN 'total_page_below_1' WHEN 5 THEN 'paging_not_integer' WHEN 6 THEN 'not_json' END AS reject_reason
FROM (SELECT page_id, html, page_id % 8 AS k, page_id % 8 IN (0, 7) AS ok FROM pages)""")
oracle("page_fragments_decode", [], """
SELECT page_id, CASE WHEN k = 0 THEN md5(html) END AS jobs_md5, CASE WHEN k = 0 THEN 'p' || page_id END AS pagination_html,
  CASE k WHEN 1 THEN 'not_an_object' WHEN 2 THEN 'not_json' WHEN 3 THEN 'jobs_html_not_a_string' WHEN 4 THEN 'pagination_html_not_a_string' END AS reject_reason
FROM (SELECT page_id, html, page_id % 5 AS k FROM pages)""")
oracle("csv_export_roundtrip", ["postings"], """
SELECT job_id, 'job-' || job_id AS slug, title, job_url, company_name, '' AS company_url, '' AS company_logo,
  coalesce(salary_freeform, '') AS salary, '' AS job_category, 'Hybrid' AS working_model, city AS location,
  array_to_string(visible_tags, '|') AS skills, replace(coalesce(remaining_tags, ''), ',', '|') AS benefits, '' AS label, posted_at,
  CAST(source_page AS BIGINT) AS source_page, CAST(scraped_at AS VARCHAR) AS scraped_at FROM postings""")
oracle("upsert_merge", ["postings"], f"""
SELECT {_SMALL} FROM postings
QUALIFY row_number() OVER (PARTITION BY job_id ORDER BY scraped_at >= TIMESTAMP '1998-01-01' DESC, {LAST}) = 1""")
ORACLES["upsert_versions"] = ORACLES["upsert_merge"]
cte("late_rows", ["postings"], f"""
SELECT * FROM postings WHERE scraped_at >= TIMESTAMP '1995-01-01' AND scraped_at < TIMESTAMP '1997-01-01'
  AND job_id NOT IN (SELECT job_id FROM postings WHERE scraped_at >= TIMESTAMP '1997-01-01') QUALIFY row_number() OVER (PARTITION BY job_id ORDER BY {LAST}) = 1""")
cte("rows_they_replace", ["postings", "late_rows"], f"""
SELECT * FROM postings WHERE scraped_at < TIMESTAMP '1995-01-01' AND job_id IN (SELECT job_id FROM late_rows)
  QUALIFY row_number() OVER (PARTITION BY job_id ORDER BY {LAST}) = 1""")
oracle("upsert_changes", ["late_rows", "rows_they_replace"], f"""
SELECT CAST(1 AS INTEGER) AS sign, {_SMALL} FROM late_rows UNION ALL SELECT CAST(-1 AS INTEGER), {_SMALL} FROM rows_they_replace""")
oracle("incremental_upsert", ["latest"], f"SELECT {_SMALL} FROM latest")
oracle("incremental_late_file", ["latest"], f"SELECT {_SMALL} FROM latest")
oracle("silver_mixed_times", ["postings"], """
SELECT job_id, title, CASE WHEN position % 3 <> 1 THEN CAST(epoch(CAST(scraped_at AS TIMESTAMP)) AS BIGINT) END AS seconds FROM postings
QUALIFY row_number() OVER (PARTITION BY job_id ORDER BY CASE WHEN position % 3 <> 1 THEN scraped_at END DESC NULLS LAST, source_page DESC, position DESC) = 1""")
oracle("gold_materialize", GOLD, """
SELECT 'career_data_engineer' AS model, CAST(NumberofDataEngineer AS VARCHAR) AS row FROM g_career
UNION ALL SELECT 'skil_DE_need', skill || '|' || job_count FROM g_skills
UNION ALL SELECT 'hiring_seniority', seniority || '|' || total_jobs FROM g_seniority
UNION ALL SELECT 'Luong_trung_binh_IT', CAST(trunc(LUONG_TRUNG_BINH_MIN) AS BIGINT) || '|' || CAST(trunc(LUONG_TRUNG_BINH_MAX) AS BIGINT) FROM g_salary
UNION ALL SELECT 'phan_bo_viec_lam', coalesce(city, '-') || '|' || TongCongViec FROM g_city
UNION ALL SELECT 'TheMostCVinData', primary_role || '|' || avg_experience_years || '|' || total_jobs FROM g_data
UNION ALL SELECT 'Trend_hiring', coalesce(primary_role, '-') || '|' || TongSoTuyenDung FROM g_trend""")
ORACLES["gold_from_changes"] = ORACLES["gold_materialize"]
oracle("silver_a", ["clean_a"], """
SELECT job_id, min_salary, max_salary, currency, period, parse_status, title, job_url, company_name, 'Hybrid' AS working_model,
  city AS location, array_to_string(visible_tags, '|') AS skills, replace(coalesce(remaining_tags, ''), ',', '|') AS benefits,
  posted_at, CAST(scraped_at AS VARCHAR) AS scraped_at FROM clean_a""")
oracle("silver_b", ["clean_b"], """
SELECT job_id, job_url, title, city, company_name, 'https://jobs.example.com/apply/' || job_id AS apply_url,
  'level-' || source_page AS verification_level, salary_min, salary_max, salary_currency, salary_period, salary_parse_error,
  CAST(scraped_at AS VARCHAR) AS scraped_at, role_group, primary_role, array_to_string(secondary, '|') AS secondary_roles, seniority,
  years AS experience_years, array_to_string(skill_list, '|') AS skills, is_multi_role, status AS parse_status,
  CAST(NULL AS VARCHAR) AS parse_error FROM clean_b""")
oracle("scraped_at_parse", ["postings"], f"""
SELECT {ROW}, CASE position % 3 WHEN 0 THEN strftime(scraped_at, '%Y-%m-%dT%H:%M:%S') || '.250000+00:00'
    WHEN 1 THEN strftime(scraped_at, '%Y-%m-%dT%H:%M:%S') ELSE 'not a time' END AS text,
  CASE position % 3 WHEN 0 THEN epoch_us(scraped_at) + 250000 WHEN 1 THEN epoch_us(scraped_at) - 25200000000 END AS micros
FROM postings""")

_TAGS = "array_to_string(visible_tags, '|')"
oracle("html_cards", ["postings"], f"""
SELECT job_id, CAST(position AS VARCHAR) AS position, lpad(CAST(position AS VARCHAR), 12, '0') AS tracking_id, 'list' AS box_type, title, job_url,
  salary, city, experience, company_name, 'https://jobs.example.com/cong-ty/' || job_id || '?a=1&b=2' AS company_url,
  'https://jobs.example.com/img/' || job_id || '.png' AS logo_url, 'Tin mới' AS labels, {_TAGS} AS visible_tags,
  trim(remaining_tags) AS remaining_tags, posted_at AS posted_time, 'hôm nay' AS updated_time, 'Ứng tuyển' AS apply_text,
  'https://jobs.example.com/apply/' || job_id AS apply_url, source_page = 3 AS is_hot, source_page = 3 AS is_urgent,
  source_page = 5 AS is_pro_company, source_page % 2 = 0 AS is_verified,
  CASE WHEN source_page % 2 = 0 THEN 'level-2' END AS verification_level, position % 4 = 1 AS is_highlight,
  position % 4 = 2 AS is_flash_job, position % 4 = 3 OR source_page = 5 AS is_diamond_employer,
  CAST(source_page AS BIGINT) AS source_page, CAST(scraped_at AS VARCHAR) AS scraped_at
FROM postings
UNION ALL
SELECT 'bare-' || job_id, NULL, NULL, NULL, title, job_url, salary, NULL, NULL, company_name, NULL,
  'https://jobs.example.com/s.png', '', '', NULL, NULL, NULL, NULL, NULL, false, false, false, false, NULL, false, false, false,
  CAST(source_page AS BIGINT), CAST(scraped_at AS VARCHAR)
FROM postings WHERE position % 3 = 0""")
oracle("html_cards_a", ["postings"], f"""
SELECT job_id, 's-' || lpad(CAST(position AS VARCHAR), 12, '0') AS slug, title, split_part(job_url, '?', 1) AS job_url, company_name,
  'https://jobs.example.com/companies/b' AS company_url, '/a.png' AS company_logo, coalesce(salary_freeform, '') AS salary,
  'IT' AS job_category, 'At office' AS working_model, city AS location, {_TAGS} AS skills,
  CASE WHEN position % 2 = 0 THEN 'Lunch Gym|Gym|Gym' ELSE '' END AS benefits, '' AS label, replace(posted_at, 'Posted ', '') AS posted_at,
  CAST(source_page AS BIGINT) AS source_page, CAST(scraped_at AS VARCHAR) AS scraped_at
FROM postings""")
_NAV = "regexp_extract(html, '(?s)<nav>(.*?)</nav>', 1)"
oracle("html_nav_links", [], f"""
SELECT page_id, array_to_string(regexp_extract_all(nav, '<a href="([^"]*)">', 1), '|') AS hrefs,
  array_to_string(list_filter(list_transform(regexp_extract_all(nav, '<a [^>]*>([^<]*)</a>', 1), lambda x: trim(replace(x, '&amp;', '&'))), lambda x: x <> ''), '|') AS texts,
  CAST(len(regexp_extract_all(nav, '<a ')) AS INTEGER) AS n_links
FROM (SELECT page_id, {_NAV} AS nav FROM pages)""")


def unescaped(sql: str) -> str:
    for entity, char in [("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "''"), ("&nbsp;", " "), ("&copy;", "©"), ("&middot;", "·"), ("&amp;", "&")]:
        sql = f"replace({sql}, '{entity}', '{char}')"
    return sql


def text_of(sql: str) -> str:
    visible = f"regexp_replace(regexp_replace({sql}, '(?s)<!--.*?-->|<script[^>]*>.*?</script>|<style[^>]*>.*?</style>', ' ', 'g'), '<[^>]*>', ' ', 'g')"
    return squeezed(unescaped(visible))


oracle("html_text_normalize", [], f"""
SELECT page_id, nullif({text_of("regexp_extract(html, '(?s)<h1>(.*?)</h1>', 1)")}, '') AS heading,
  md5({text_of("regexp_extract(html, '(?s)<body>(.*?)</body>', 1)")}) AS body_md5,
  CAST(NULL AS VARCHAR) AS missing_or_null, '' AS missing_or_blank FROM pages""")
_FIRST_HREF = "nullif(trim(" + unescaped("regexp_extract(html, '<a href=\"([^\"]*)\"', 1)") + "), '')"
_LANG = "nullif(regexp_extract(html, '<html lang=\"([^\"]*)\"', 1), '')"
oracle("html_attr", [], f"""
SELECT page_id, {_LANG} AS lang, 'utf-8' AS charset, {_FIRST_HREF} AS first_href, CAST(NULL AS VARCHAR) AS missing FROM pages""")
oracle("html_fallback", [], f"""
SELECT page_id, CASE WHEN page_id % 3 = 0 THEN {_LANG} ELSE nullif({text_of("regexp_extract(html, '(?s)<title>(.*?)</title>', 1)")}, '') END AS label,
  {_FIRST_HREF} AS link FROM pages""")
oracle("html_flags", [], """
SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, CAST(l_shipdate AS VARCHAR) AS l_shipdate, l_partkey % 3 = 0 AS is_highlight,
  false AS is_diamond_employer, CASE WHEN l_partkey % 5 = 0 THEN 'level-' || l_linenumber WHEN l_suppkey % 7 = 0 THEN 'level-9' END AS verification_level
FROM lineitem""")
oracle("html_first_nonempty_link", [], f"""
SELECT page_id, hrefs[i] AS href, trim(replace(texts[i], '&amp;', '&')) AS text FROM (
  SELECT page_id, hrefs, texts, list_position(list_transform(texts, lambda x, j: trim(x) <> '' AND NOT (j = 1 AND page_id % 2 = 0)), true) AS i
  FROM (SELECT page_id, regexp_extract_all({_NAV}, '<a href="([^"]*)">', 1) AS hrefs, regexp_extract_all({_NAV}, '<a [^>]*>([^<]*)</a>', 1) AS texts FROM pages))""")
oracle("posted_prefix_strip", ["postings"], f"""
SELECT {ROW}, regexp_replace(CASE WHEN position % 2 = 0 THEN upper(posted_at) ELSE posted_at END, '^(?i)posted ', '') AS posted FROM postings""")

_REL = "regexp_replace(url, '^https?://[^/]+', '')"
oracle("url_canonical", [], f"""
SELECT page_id, CASE page_id % 4 WHEN 1 THEN {_REL} WHEN 2 THEN regexp_replace(url, '^https?:', '') WHEN 3 THEN '' ELSE url END AS url,
  CASE page_id % 4 WHEN 1 THEN 'https://jobs.example.com' || regexp_replace({_REL}, '[?#].*', '')
    WHEN 2 THEN 'https:' || regexp_replace(regexp_replace(url, '^https?:', ''), '[?#].*', '') WHEN 3 THEN ''
    ELSE regexp_replace(url, '[?#].*', '') END AS canonical FROM pages""")
oracle("url_absolute", [], f"""
SELECT page_id, CASE page_id % 4 WHEN 1 THEN {_REL} WHEN 2 THEN '/a/..' || {_REL} WHEN 3 THEN '' ELSE url END AS url,
  CASE page_id % 4 WHEN 3 THEN NULL WHEN 0 THEN url ELSE 'https://jobs.example.com' || {_REL} END AS absolute FROM pages""")
oracle("url_set_param", [], r"""
SELECT page_id, base || CASE page_id % 3 WHEN 0 THEN '?page=7&q=a%20b~*&page=9&e=' WHEN 1 THEN '?q=đ&&x' ELSE '' END || tail AS url,
  base || CASE page_id % 3 WHEN 0 THEN '?page=' || n || '&q=a+b~%2A&e=' WHEN 1 THEN '?q=%C4%91&x=&page=' || n ELSE '?page=' || n END || tail AS paged
FROM (SELECT page_id, regexp_replace(url, '[?#].*$', '') AS base, page_id % 50 + 1 AS n, CASE page_id % 2 WHEN 0 THEN '#top' ELSE '' END AS tail FROM pages)""")
oracle("url_build", ["postings"], f"""
SELECT {ROW}, 'https://jobs.example.com/search?type_keyword=1&page=' || source_page || '&q=' || replace(url_encode(title), '%20', '+')
  || '&city=' || replace(url_encode(city || ' & (~*)'), '%20', '+') AS url FROM postings""")
oracle("url_match", ["postings"], f"""
SELECT {ROW}, 'https://jobs.example.com/search' || CASE source_page WHEN 1 THEN '/' WHEN 2 THEN '/x' ELSE '' END || '?' ||
  CASE position % 8 WHEN 0 THEN 'type=1&page=1&u=abc' WHEN 1 THEN 'u=a%20b&page=1&type=1' WHEN 2 THEN 'type=1&page=2&u=abc'
    WHEN 3 THEN 'type=1&page=1&u=%20' WHEN 4 THEN 'type=1&page=1&u=abc&exp=2' WHEN 5 THEN 'type=1&type=1&u=abc' WHEN 6 THEN 'type=1&page=1'
    ELSE 'type=1&page=1&page=1&u=abc' END AS url, position % 8 IN (0, 1) AND source_page <> 2 AS matched FROM postings""")
oracle("page_count", ["postings"], f"""
SELECT {ROW}, n AS total_pages, CASE WHEN position % 2 = 0 THEN least(40, n) ELSE n END AS last_page
FROM (SELECT *, CAST(greatest(1, source_page, position % 90 + 1, CASE WHEN position % 5 = 0 THEN 95 ELSE 0 END) AS INTEGER) AS n FROM postings)""")
oracle("page_count_text", ["postings"], f"""
SELECT {ROW}, CASE WHEN position % 3 <> 2 THEN CAST(position AS INTEGER) END AS pages FROM postings""")
cte("crawl_pages", [], """
SELECT l_suppkey AS crawl_id, asked_page, CASE WHEN asked_page % 97 = 0 THEN asked_page + 1 WHEN asked_page < 50 THEN 1 ELSE asked_page END AS current_page,
  CASE WHEN asked_page % 89 = 0 THEN 11 ELSE 10 END AS total_page,
  CASE l_suppkey % 3 WHEN 0 THEN 10 WHEN 1 THEN 9 END AS shown_pages
FROM (SELECT DISTINCT l_suppkey, l_partkey + 1 AS asked_page FROM lineitem)""")
oracle("crawl_consistency", ["crawl_pages"], """
SELECT crawl_id, asked_page, current_page, total_page, shown_pages, violation FROM (
  SELECT *, unnest([CASE WHEN f AND current_page <> 1 THEN 'first_page_not_1' END,
    CASE WHEN NOT f AND current_page <> asked_page THEN 'wrong_page_returned' END,
    CASE WHEN total_page <> expected THEN 'total_page_changed' END,
    CASE WHEN f AND shown_pages <> total_page THEN 'shown_pages_differ' END]) AS violation
  FROM (SELECT *, row_number() OVER w = 1 AS f, first_value(total_page) OVER w AS expected FROM crawl_pages WINDOW w AS (PARTITION BY crawl_id ORDER BY asked_page)))
WHERE violation IS NOT NULL""")
oracle("crawl_ledger", ["postings"], """
SELECT crawl, page, count(*) AS page_rows, CAST(sum(is_new) AS BIGINT) AS new_keys,
  CAST(sum(sum(is_new)) OVER (PARTITION BY crawl ORDER BY page) AS BIGINT) AS distinct_so_far
FROM (SELECT strftime(scraped_at, '%Y') AS crawl, position AS page,
    CASE WHEN row_number() OVER (PARTITION BY strftime(scraped_at, '%Y'), job_id ORDER BY position) = 1 THEN 1 ELSE 0 END AS is_new FROM postings)
GROUP BY crawl, page""")

cte("crawled", ["postings"], """
SELECT *, max(page) OVER (PARTITION BY month) AS pages FROM (
  SELECT *, CAST((row_number() OVER (PARTITION BY month ORDER BY job_id, source_page, position) - 1) // 30 + 1 AS INTEGER) AS page, month || '-28T01:02:03+00:00' AS crawl_time
  FROM (SELECT *, strftime(scraped_at, '%Y-%m') AS month, CAST(strftime(scraped_at, '%m') AS INTEGER) AS m FROM postings))""")


def sinks(read: str, of: str, tracking: str, rejects: str, violations: str, beyond: str) -> str:
    """Rows, ledger, rejects, violations and pages beyond, of the cards on the pages read; keys are job ids."""
    return f"""
SELECT 'row' AS sink, concat_ws('|', job_id, {tracking}, title, {of}, page, crawl_time) AS row FROM {read}
  QUALIFY row_number() OVER (PARTITION BY crawl_time, job_id ORDER BY page DESC, position DESC, posted_at DESC) = 1
UNION ALL SELECT 'ledger', concat_ws('|', crawl_time, page, n, new, CAST(sum(new) OVER (PARTITION BY crawl_time ORDER BY page) AS BIGINT)) FROM (
  SELECT crawl_time, page, count(*) AS n, count(*) FILTER (again = 1) AS new FROM (
    SELECT *, row_number() OVER (PARTITION BY crawl_time, job_id ORDER BY page) AS again FROM {read}) GROUP BY crawl_time, page)
UNION ALL SELECT DISTINCT 'reject', concat_ws('|', month, page, {rejects}) FROM crawled WHERE {rejects} IS NOT NULL
UNION ALL SELECT 'violation', concat_ws('|', month, page, v) FROM ({violations})
UNION ALL SELECT DISTINCT 'beyond', concat_ws('|', month, page) FROM crawled WHERE {rejects} IS NULL AND {beyond}"""


_LINK = "split_part(job_url, '?', 1)"
_REJECT_B, _REJECT_A = "CASE WHEN page % 5 = 2 THEN 'status_not_success' END", "CASE page % 7 WHEN 3 THEN 'not_an_object' WHEN 5 THEN 'not_json' END"
# A crawl of month 5 ends before page 3, of month 9 before page 4, of month 11 at once.
cte("read_b", ["crawled"], "SELECT * FROM crawled WHERE page % 5 <> 2 AND NOT (m = 5 AND page >= 3 AND pages >= 3) AND NOT (m = 9 AND page >= 4 AND pages >= 4) AND m <> 11")
oracle("ingest_b", ["crawled", "read_b"], sinks("read_b", "city, job_url", "lpad(CAST(position AS VARCHAR), 12, '0')", _REJECT_B, """
SELECT DISTINCT month, page, CASE WHEN m = 5 THEN 'wrong_page_returned' WHEN m = 9 THEN 'total_page_changed' ELSE 'shown_pages_differ' END AS v
FROM crawled WHERE m = 5 AND page = 3 OR m = 9 AND page = 4 OR m = 11 AND page = 1""", "false"))
_LAST = "least(20, greatest(pages - 2, 1))"
cte("read_a", ["crawled"], f"SELECT * FROM crawled WHERE page % 7 NOT IN (3, 5) AND page <= {_LAST}")
oracle("ingest_a", ["crawled", "read_a"], sinks("read_a", f"city, {_LINK}", "'s-' || lpad(CAST(position AS VARCHAR), 12, '0')", _REJECT_A,
                                               "SELECT month, page, '' AS v FROM crawled WHERE false", f"page > {_LAST}"))

_SAL = "salary_min, salary_max, salary_currency, salary_period, salary_type, salary_parse_status, salary_parser_version, salary_parse_error"
oracle("salary_token_parse", ["with_salary"], f"SELECT {ROW}, salary, {_SAL} FROM with_salary")
oracle("salary_range", ["with_salary"], f"SELECT {ROW}, salary_min, salary_max, salary_currency, salary_parse_error FROM with_salary WHERE salary_type = 'range'")
oracle("salary_type_counts", ["with_salary"], "SELECT salary_type, count(*) AS n FROM with_salary GROUP BY ALL")
oracle("salary_error_profile", ["with_salary"], "SELECT salary_type, salary_parse_status, salary_parse_error, count(*) AS n FROM with_salary GROUP BY ALL")
oracle("salary_freeform", ["postings", "free_salary"], f"""
SELECT {ROW}, salary_freeform, min_salary, max_salary, currency, period, parse_status
FROM postings JOIN free_salary ON salary_freeform IS NOT DISTINCT FROM free_text""")
oracle("tags_normalize", ["postings", "tag_sets"], f"""
SELECT {ROW}, array_to_string(rem, '|') AS remaining, array_to_string(vis, '|') AS visible, CAST(len(rem) AS INTEGER) AS n_remaining
FROM postings p JOIN tag_sets s ON p.remaining_tags IS NOT DISTINCT FROM s.remaining_tags AND p.visible_tags IS NOT DISTINCT FROM s.visible_tags""")
oracle("experience_years", ["postings", "years"], f"SELECT {ROW}, experience, years FROM postings JOIN years ON experience IS NOT DISTINCT FROM exp_text")
oracle("experience_validate", ["postings"], f"""
SELECT {ROW}, CASE position % 5 WHEN 0 THEN NULL WHEN 1 THEN 'not_finite_or_negative' WHEN 2 THEN 'not_finite_or_negative' WHEN 3 THEN NULL
  ELSE CASE WHEN source_page % 2 = 1 THEN 'not_half_step' END END AS error FROM postings""")
oracle("seniority", ["classified"], f"SELECT {ROW}, title, seniority FROM classified")
oracle("role_group", ["classified"], f"SELECT {ROW}, primary_role, CASE WHEN primary_role IS NOT NULL THEN role_group END AS role_group FROM classified")
oracle("primary_role", ["classified"], f"SELECT {ROW}, title, primary_role FROM classified")
oracle("title_roles_from_table", ["postings"], f"""
SELECT text, string_agg(role, '|' ORDER BY prio) AS roles FROM (
  SELECT text, role, min(prio) AS prio FROM (SELECT DISTINCT title || ' / ' || city AS text FROM postings)
  JOIN {ROLE_VALUES} ON contains({phrase_words('text')}, ' ' || phrase || ' ') GROUP BY text, role) GROUP BY text""")
oracle("secondary_roles", ["classified"], f"SELECT {ROW}, array_to_string(secondary, '|') AS secondary_roles, is_multi_role FROM classified")
oracle("skills_normalize", ["classified"], f"SELECT {ROW}, array_to_string(skill_list, '|') AS skills FROM classified")
oracle("classify_status", ["classified"], f"SELECT {ROW}, role_group, status AS parse_status, CAST(len(skill_list) AS INTEGER) AS n_skills FROM classified")

oracle("classify_from_tables", ["branded"], f"""
SELECT {ROW}, primary_role, array_to_string(secondary, '|') AS secondary_roles, role_group, array_to_string(skill_list, '|') AS skills, seniority,
  status AS parse_status FROM branded""")

_NUMBERS = "list_max(list_transform(regexp_extract_all(coalesce(experience, ''), '[0-9]+'), lambda x: CAST(x AS DOUBLE)))"
_ROWKEY = "job_id || '/' || source_page || '/' || position || '/' || CAST(scraped_at AS VARCHAR) AS row_key"
oracle("enrich_partitions", ["postings"], f"SELECT {_ROWKEY}, {_NUMBERS} AS years, 'success' AS status, CAST(NULL AS VARCHAR) AS message FROM postings")
oracle("enrich_error_rows", ["postings"], f"""
SELECT {_ROWKEY}, CASE WHEN position % 7 <> 0 THEN {_NUMBERS} END AS years, CASE WHEN position % 7 = 0 THEN 'error' ELSE 'success' END AS status,
  CASE WHEN position % 7 = 0 THEN 'no answer for ' || position END AS message FROM postings""")
oracle("enrich_required_fields", ["postings"], f"""
SELECT {_ROWKEY}, coalesce({_NUMBERS}, -1.0) AS years, CASE WHEN {_NUMBERS} IS NULL THEN 'error' ELSE 'success' END AS status,
  CASE WHEN {_NUMBERS} IS NULL THEN 'required field years is null' END AS message FROM postings""")
oracle("enrich_known_answers", ["postings"], f"""
SELECT {ROW}, title, experience, city, CASE WHEN title NOT LIKE 'BrSE%' THEN {_NUMBERS} END AS years,
  CASE WHEN title LIKE 'BrSE%' THEN 'error' ELSE 'success' END AS status, CASE WHEN title LIKE 'BrSE%' THEN 'no answer for ' || title END AS message,
  title NOT LIKE 'BrSE%' AND bool_or(position % 5 = 0) OVER (PARTITION BY title, experience, city) AS known FROM postings""")
oracle("salary_reply_decode", ["postings"], f"""
SELECT {ROW}, CASE WHEN position % 6 = 0 THEN 10.5 END::DOUBLE AS min_salary, CASE WHEN position % 6 = 0 THEN 20.0 END::DOUBLE AS max_salary,
  CASE WHEN position % 6 = 0 THEN 'USD' END AS currency, CASE WHEN position % 6 = 0 THEN 'month' END AS period,
  CASE WHEN position % 6 = 0 THEN 'success' ELSE 'failed' END AS parse_status FROM postings""")
oracle("reply_decode", ["postings"], f"""
SELECT {ROW}, CASE WHEN n IN (0, 1) THEN 'Data' END AS role_group, CASE WHEN n IN (0, 1) THEN 'Data Engineer' END AS primary_role,
  CASE WHEN n IN (0, 1) THEN 'A|B' ELSE '' END AS secondary_roles, CASE WHEN n IN (0, 1) THEN 'Junior' ELSE 'Unknown' END AS seniority,
  CASE n WHEN 0 THEN 1.5 WHEN 8 THEN 2.0 END::DOUBLE AS experience_years, CASE WHEN n IN (0, 1) THEN 'SQL|Python' ELSE '' END AS skills,
  n IN (0, 1) AS is_multi_role, CASE WHEN n IN (0, 1) THEN 'ambiguous' WHEN n = 8 THEN 'success' ELSE 'error' END AS parse_status,
  CASE n WHEN 2 THEN 'not_finite_or_negative' WHEN 3 THEN 'not_half_step' WHEN 4 THEN 'not_a_valid_reply' WHEN 5 THEN 'not_a_valid_reply'
    WHEN 6 THEN 'missing_experience_years' WHEN 7 THEN 'unknown_seniority' END AS parse_error
FROM (SELECT *, position % 9 AS n FROM postings)""")
oracle("prompt_record", ["postings", "tag_sets"], f"""
SELECT {ROW}, CAST(to_json({{'job_id': job_id, 'title': title, 'remaining_tags': rem, 'visible_tags': vis, 'experience': experience}}) AS VARCHAR) AS record
FROM postings p JOIN tag_sets s ON p.remaining_tags IS NOT DISTINCT FROM s.remaining_tags AND p.visible_tags IS NOT DISTINCT FROM s.visible_tags""")
oracle("join_parsed", ["postings", "with_salary"], f"""
SELECT {ROW}, title, salary_min, salary_type FROM postings
JOIN (SELECT job_id, salary_min, salary_type FROM with_salary QUALIFY row_number() OVER (PARTITION BY job_id ORDER BY {LAST}) = 1) USING (job_id)""")
oracle("dedup_latest", ["latest"], f"SELECT {_SMALL} FROM latest")
oracle("dedup_fallback_key", ["postings"], f"""
SELECT job_id_raw, url AS job_url, title, source_page, position, CAST(scraped_at AS VARCHAR) AS scraped_at, job_id FROM (
  SELECT *, CASE source_page WHEN 1 THEN NULL WHEN 2 THEN '' ELSE job_url END AS url FROM postings)
WHERE coalesce(nullif(job_id_raw, ''), nullif(url, '')) IS NOT NULL
QUALIFY row_number() OVER (PARTITION BY coalesce(nullif(job_id_raw, ''), nullif(url, '')) ORDER BY {LAST}, job_id DESC) = 1""")

oracle("gold_career_count", ["g_career"], "SELECT * FROM g_career")
oracle("gold_top_skills", ["g_skills"], "SELECT * FROM g_skills")
oracle("gold_seniority", ["g_seniority"], "SELECT * FROM g_seniority")
oracle("gold_avg_salary", ["g_salary"], "SELECT * FROM g_salary")
oracle("gold_city", ["g_city"], "SELECT * FROM g_city")
oracle("gold_data_roles", ["g_data"], "SELECT * FROM g_data")
oracle("gold_role_trend", ["g_trend"], "SELECT * FROM g_trend")
oracle("value_frequency", ["postings"], "SELECT salary, count(salary) AS n FROM postings GROUP BY salary")
oracle("report_top_skills", ["g_skills"], "SELECT * FROM g_skills ORDER BY job_count DESC, skill LIMIT 10")
oracle("report_top_cities", ["g_city"], "SELECT * FROM g_city ORDER BY TongCongViec DESC, city LIMIT 5")
oracle("report_top_data_roles", ["g_data"], "SELECT * FROM g_data ORDER BY total_jobs DESC, primary_role LIMIT 10")
oracle("report_top_roles", ["g_trend"], "SELECT * FROM g_trend ORDER BY TongSoTuyenDung DESC, primary_role NULLS FIRST LIMIT 10")
oracle("report_seniority", ["g_seniority"], "SELECT * FROM g_seniority")
oracle("report_lines", ["lists"], "SELECT list, text FROM lists UNION ALL SELECT 'nothing', 'Không có dữ liệu'")


def _text_of(name: str) -> str:
    return f"(SELECT text FROM lists WHERE list = '{name}')"


REPORT_SQL = f"""
SELECT '📊 **BÁO CÁO TUYỂN DỤNG IT — 07/03/2024**' || chr(10) || chr(10) ||
  '🆕 [Data Engineer] Tổng số tin tuyển dụng: **' || (SELECT NumberofDataEngineer FROM g_career) || '**' || chr(10) || chr(10) ||
  '🛠️ [Data Engineer] Top kỹ năng được yêu cầu nhiều nhất:' || chr(10) || {_text_of('skills')} || chr(10) || chr(10) ||
  '🧑‍💼 [Toàn ngành IT] Phân bố theo cấp bậc:' || chr(10) || {_text_of('seniority')} || chr(10) || chr(10) ||
  '💰 [Toàn ngành IT] Lương trung bình (VNĐ): **' || (SELECT format('{{:,.0f}} — {{:,.0f}}', LUONG_TRUNG_BINH_MIN, LUONG_TRUNG_BINH_MAX) FROM g_salary) || '**' || chr(10) || chr(10) ||
  '📍 [Toàn ngành IT] Top 5 thành phố nhiều tin tuyển dụng nhất:' || chr(10) || {_text_of('cities')} || chr(10) || chr(10) ||
  '📈 [Toàn ngành IT] Top vị trí liên quan Data (theo số tin & KN trung bình):' || chr(10) || {_text_of('data_roles')} || chr(10) || chr(10) ||
  '🔥 [Toàn ngành IT] Xu hướng tuyển dụng theo vị trí:' || chr(10) || {_text_of('trend')} || chr(10) AS report"""
oracle("report_text", ["lists", "g_career", "g_salary"], REPORT_SQL)

# Board B of the daily run also has the bare cards: the same definitions on more postings.
cte("postings_of_b", ["postings"], """
SELECT * FROM postings UNION ALL
SELECT * REPLACE ('bare-' || job_id AS job_id, CAST(NULL AS VARCHAR) AS experience, CAST([] AS VARCHAR[]) AS visible_tags,
  CAST(NULL AS VARCHAR) AS remaining_tags, CAST(NULL AS VARCHAR) AS city) FROM postings WHERE position % 3 = 0""")
_BOARD_A = {"g_career", "g_skills"}


def on_board_b(name: str) -> str:
    """Define `name` and what it needs once more over board B's postings; returns the new name."""
    if name == "postings":
        return "postings_of_b"
    if name in _BOARD_A:
        return name
    new = f"{name}_of_b"
    if new not in CTES:
        needs = {n: on_board_b(n) for n in NEEDS[name]}
        sql = CTES[name]
        for old, other in needs.items():
            sql = re.sub(rf"\b(FROM|JOIN)(\s+){old}\b", rf"\1\2{other}", sql)
        cte(new, list(needs.values()), sql)
    return new


_lists, _salary = on_board_b("lists"), on_board_b("g_salary")
oracle("daily_run", [_lists, "g_career", _salary], re.sub(r"\bFROM g_salary\b", f"FROM {_salary}", re.sub(r"\bFROM lists\b", f"FROM {_lists}", REPORT_SQL)))
