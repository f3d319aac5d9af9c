"""The registered queries restated as SQL for DuckDB.

Written against the flat inputs and, where there is a choice, in another shape
than the Spark side: mapping tables joined and ranked instead of CASE chains,
row_number instead of a distributed numbering, UNION instead of unnested tags.
"""

from __future__ import annotations

from bundlescope import fixed_values as fixed
from bundlescope.functions.html import CHARACTER_REFERENCES
from bundlescope.functions.rules import SEGMENT_RULES, SegmentRule
from bundlescope.plans.inputs import INPUTS, MASTER_COLUMNS, with_inputs

_COLUMNS = MASTER_COLUMNS.split(", ")
_OTHERS = [c for c in _COLUMNS if c != "bundle"]
_TABLE_COLUMNS = [c for c in _COLUMNS if c not in ("segment", "segment_grp_2", "details")]
_COUNTRIES = ", ".join(f"'{c}'" for c in fixed.COUNTRIES)


def _text(value: object) -> str:
    return "CAST(NULL AS VARCHAR)" if value is None else f"'{value}'"


def _values(rows: list[tuple[object, ...]]) -> str:
    return ", ".join(
        "(" + ", ".join(str(v) if isinstance(v, int) else _text(v) for v in row) + ")" for row in rows
    )


def _mapping(pairs: list[tuple[str, object]]) -> str:
    rows = [(n, key, value) for n, (key, value) in enumerate(pairs)]
    return f"SELECT * FROM (VALUES {_values(rows)}) AS m(pos, key, value)"


def _flat(groups: tuple) -> list[tuple[str, object]]:
    return [(member, value) for members, value in groups for member in members]


# ---- rules -----------------------------------------------------------------


def _rule(rule: SegmentRule, source: str) -> str:
    tests = [f"segment_grp = '{rule.group}'"]
    tests += [f"segment_grp_1 = '{g}'" for g in rule.only_from]
    tests += [f"segment_grp_1 <> '{g}'" for g in rule.never_from]
    if rule.words:
        found = [f"contains({c}, '{w}')" for c in ("app_name", "details") for w in rule.words]
        tests.append(f"({' OR '.join(found)})")
    return (
        f"SELECT * REPLACE (CASE WHEN {' AND '.join(tests)} THEN '{rule.becomes}' "
        f"ELSE segment_grp_1 END AS segment_grp_1) FROM {source}"
    )


def _refined(name: str, source: str) -> dict[str, str]:
    """A chain of views, one per rule, the last one called ``name``."""
    views, before = {}, source
    for n, rule in enumerate(SEGMENT_RULES):
        step = name if n == len(SEGMENT_RULES) - 1 else f"{name}_{n}"
        views[step] = _rule(rule, before)
        before = step
    return views


# ---- merging ---------------------------------------------------------------


def _refreshed(new: str, old: str) -> str:
    kept = ", ".join(f"n.{c}" for c in _COLUMNS if c != "segment_index")
    return (
        f"SELECT {kept}, r.segment_index FROM {new} n LEFT JOIN (SELECT DISTINCT segment_grp_1, "
        f"segment_index FROM {old} WHERE segment_index IS NOT NULL) r "
        f"ON n.segment_grp_1 = r.segment_grp_1"
    )


def _merged(old: str, refreshed: str) -> str:
    order = ", ".join(f"{c} ASC NULLS FIRST" for c in ["list", *_OTHERS])
    return (
        f"SELECT {MASTER_COLUMNS} FROM (SELECT *, row_number() OVER (PARTITION BY bundle "
        f"ORDER BY {order}) AS choice FROM (SELECT 0 AS list, {MASTER_COLUMNS} FROM {old} "
        f"UNION ALL SELECT 1 AS list, {MASTER_COLUMNS} FROM {refreshed}) "
        f"WHERE bundle <> '' AND bundle IS NOT NULL) WHERE choice = 1"
    )


# ---- persona view ----------------------------------------------------------


def _persona_table(source: str) -> str:
    return f"SELECT {', '.join(f'CAST({c} AS VARCHAR) AS {c}' for c in _TABLE_COLUMNS)} FROM {source}"


def _persona(source: str, primary: bool) -> str:
    names = "map_persona_primary" if primary else "map_persona"
    return (
        f"SELECT s.*, CASE WHEN COALESCE(s.segment_grp_1, '') = '' THEN '{fixed.NOT_FOUND}' "
        f"ELSE COALESCE(n.value, s.segment_grp_1) END AS persona, "
        f"CAST(k.value AS DECIMAL(3,1)) AS rank "
        f"FROM {source} s LEFT JOIN {names} n ON s.segment_grp_1 = n.key "
        f"LEFT JOIN map_rank k ON s.segment_grp_1 = k.key"
    )


def _persona_view(table: str) -> str:
    names = ", ".join(_TABLE_COLUMNS)
    return (
        f"SELECT {names}, persona, rank, CASE WHEN category IS NULL THEN '{fixed.NOT_FOUND}' "
        f"ELSE (SELECT arg_min(m.value, m.pos) FROM map_category m WHERE p.category LIKE m.key) "
        f"END AS app_category FROM ({_persona(table, True)}) p "
        f"UNION SELECT {names}, persona, rank, t.value AS app_category "
        f"FROM ({_persona(table, False)}) q JOIN map_second t ON q.category = t.key"
    )


# ---- store pages -----------------------------------------------------------


def _decoded(expression: str) -> str:
    for reference, character in (*CHARACTER_REFERENCES, ("&#8211;", "\u2013"), ("&eacute;", "\u00e9")):
        quoted = character.replace("'", "''")
        expression = f"replace({expression}, '{reference}', '{quoted}')"
    return expression


_COMMENTLESS = "regexp_replace({0}, '<!--.*?-->|<script.*?</script>|<style.*?</style>', '', 'gs')"
_EMPTY_RECORD = ", ".join(
    f"'{fixed.NOT_FOUND if f == 'app_cat' else ''}' AS {f}" for f in fixed.METADATA_FIELDS
)


def _inner(column: str, opening: str, tag: str) -> str:
    inside = f"regexp_extract({column}, '{opening}(.*?)</{tag}>', 1, 's')"
    return _decoded(f"regexp_replace({inside}, '<[^>]*>', '', 'g')")


def _record_or_null(test: str, **fields: str) -> str:
    return ", ".join(
        f"CASE WHEN {test} THEN {fields.get(name, chr(39) * 2)} END AS {name}"
        for name in fixed.METADATA_FIELDS
    )


def _lookup_fields() -> str:
    parts = []
    for ours, theirs in zip(fixed.METADATA_FIELDS, fixed.LOOKUP_FIELDS):
        default = fixed.NOT_FOUND if ours == "app_cat" else ""
        parts.append(
            f"CASE WHEN NOT found THEN '{default}' "
            f"WHEN list_contains(json_keys(answer, '$.results[0]'), '{theirs}') "
            f"THEN json_extract_string(answer, '$.results[0].{theirs}') ELSE '' END AS {ours}"
        )
    return ", ".join(parts)


# ---- views -----------------------------------------------------------------

VIEWS = {
    **INPUTS,
    "fx_sightings": """
SELECT country, date, ifa, rare AS bundle FROM fx_records WHERE form = 'list'
UNION ALL SELECT country, date, ifa, popular FROM fx_records WHERE form = 'list'
UNION ALL SELECT country, date, ifa, everywhere FROM fx_records WHERE form = 'list'""",
    "v_known": f"""
SELECT bundle, category FROM fx_known_apps
WHERE category IS NOT NULL AND category NOT IN ('', '{fixed.NOT_FOUND}')""",
    "v_devices": """
SELECT country, bundle, count(DISTINCT ifa) AS unique_ifa FROM fx_sightings GROUP BY 1, 2""",
    "v_unknown": """
SELECT d.* FROM v_devices d
WHERE NOT EXISTS (SELECT 1 FROM v_known k WHERE k.bundle = d.bundle)""",
    "v_unknown_selected": f"SELECT * FROM v_unknown WHERE country IN ({_COUNTRIES})",
    "v_audience": f"""
SELECT bundle, CAST(sum(unique_ifa) AS BIGINT) AS unique_ifa FROM v_unknown
WHERE unique_ifa > {fixed.MIN_DEVICES} GROUP BY bundle""",
    "v_all_audiences": """
SELECT bundle, CAST(sum(unique_ifa) AS BIGINT) AS unique_ifa FROM v_devices
WHERE unique_ifa > 0 AND bundle IS NOT NULL GROUP BY bundle""",
    "v_numbered": """
SELECT bundle, unique_ifa, row_number() OVER (ORDER BY bundle) AS rn FROM v_all_audiences""",
    "v_batched": f"""
SELECT *, CAST(ceil(rn / {fixed.BATCH_SIZE}.0) AS BIGINT) AS grp FROM v_numbered""",
    "v_batched_50": "SELECT *, CAST(ceil(rn / 50.0) AS BIGINT) AS grp FROM v_numbered",
    "v_lookup": f"""
SELECT bundle, {_lookup_fields()} FROM (
  SELECT bundle, answer, COALESCE(CAST(json_extract_string(answer, '$.resultCount') AS INT), 0) > 0
    AS found
  FROM (SELECT bundle, CASE WHEN json_valid(lookup_json) THEN lookup_json END AS answer
    FROM fx_payload))""",
    "v_store_a": """
SELECT bundle, {record} FROM (
  SELECT bundle, page, regexp_extract(page, '<a [^>]*itemprop=.?genre.[^>]*>') AS genre,
    regexp_extract(page, 'href=["'']?([^"''>]*)', 1) AS link,
    regexp_extract(page, 'alt="([^"]*)" class="T75of E1GfKc"', 1) AS age
  FROM (SELECT bundle, {page} AS page FROM fx_payload))""".format(
        page=_COMMENTLESS.format("html"),
        record=_record_or_null(
            "page IS NOT NULL AND (genre = '' OR link <> '')",
            app_url=f"'{fixed.STORE_A_URL}' || bundle",
            appl_name=_inner("page", '<h1 class="t" itemprop="name">', "h1"),
            app_cat="upper(string_split(link, '/')[-1])",
            app_age_grp="age",
        ),
    ),
    "v_store_b": """
SELECT bundle, {record} FROM (
  SELECT bundle, alt_html AS page, COALESCE(
    NULLIF(regexp_extract(alt_html, 'applicationSubCategory" content="([^"]*)"', 1), ''),
    regexp_extract(alt_html, 'applicationCategory" content="([^"]*)"', 1)) AS content
  FROM fx_payload)""".format(
        record=_record_or_null(
            "page IS NOT NULL",
            app_url=f"'{fixed.STORE_B_URL}' || bundle",
            appl_name=_inner("page", '<h1 itemprop="name">', "h1"),
            app_cat="upper(content[1]) || lower(content[2:])",
        ),
    ),
    "v_metadata": f"""
SELECT * FROM v_lookup WHERE regexp_full_match(bundle, '[0-9]+')
UNION ALL SELECT * FROM v_store_a WHERE NOT regexp_full_match(bundle, '[0-9]+')
  AND app_url IS NOT NULL
UNION ALL SELECT b.* FROM v_store_b b JOIN v_store_a a USING (bundle)
  WHERE NOT regexp_full_match(bundle, '[0-9]+') AND a.app_url IS NULL AND b.app_url IS NOT NULL
UNION ALL SELECT bundle, {_EMPTY_RECORD} FROM v_store_b b JOIN v_store_a a USING (bundle)
  WHERE NOT regexp_full_match(bundle, '[0-9]+') AND a.app_url IS NULL AND b.app_url IS NULL""",
    "v_base": """
SELECT *, '20000201-20000229' AS source, '01/03/2000' AS last_update,
  CASE WHEN regexp_full_match(bundle, '[0-9]+') THEN 'IOS' ELSE 'ANDROID' END AS platform
FROM (SELECT DISTINCT bundle, app_url, appl_name AS name, upper(app_cat) AS app_cat, app_detail,
  app_rank, app_age_grp, app_age_grp2, unique_ifa FROM fx_metadata)""",
    "map_persona": _mapping(_flat(fixed.PERSONA_NAMES)),
    "map_persona_primary": _mapping(_flat(fixed.PERSONA_NAMES + fixed.PERSONA_NAMES_PRIMARY_ONLY)),
    "map_rank": _mapping(_flat(fixed.PERSONA_RANKS)),
    "map_category": _mapping(list(fixed.APP_CATEGORIES)),
    "map_second": _mapping(list(fixed.SECOND_TAGS)),
    "v_refreshed": _refreshed("fx_new_list", "fx_old_list"),
    "v_merged": _merged("fx_old_list", "v_refreshed"),
    **_refined("v_refined", "fx_persona_list"),
    **_refined("v_cleaned", "v_merged"),
    "v_persona_table": _persona_table("fx_persona_list"),
}


def _segmented(base: str, totals: str) -> str:
    return f"""
SELECT b.source, b.bundle, r.store_cat, r.category, '' AS segment, r.segment_grp,
  r.segment_grp AS segment_grp_1, '' AS segment_grp_2, q.segment_index, b.last_update, b.platform,
  b.name AS app_name, b.app_detail AS details, b.app_url AS link, b.app_rank, b.app_age_grp,
  b.app_age_grp2, t.ifa_cnt
FROM {base} b
LEFT JOIN fx_ref_app r ON b.app_cat = r.app_cat
LEFT JOIN fx_ref_persona q ON r.segment_grp = q.ref_segment_grp_1
LEFT JOIN {totals} t ON b.bundle = t.bundle"""


def _totals(base: str) -> str:
    return f"SELECT bundle, CAST(sum(unique_ifa) AS DOUBLE) AS ifa_cnt FROM {base} GROUP BY bundle"


VIEWS["v_totals"] = _totals("v_base")
VIEWS["v_segmented"] = _segmented("v_base", "v_totals")

# The refresh from sightings to persona view.
VIEWS["r_pending"] = f"""
SELECT bundle, CAST(sum(unique_ifa) AS DOUBLE) AS unique_ifa FROM v_unknown_selected
WHERE unique_ifa > {fixed.MIN_DEVICES} AND COALESCE(bundle NOT IN (SELECT bundle FROM fx_done), TRUE)
GROUP BY bundle"""
VIEWS["r_results"] = """
SELECT p.unique_ifa, p.bundle, COALESCE(m.app_url, '') AS app_url,
  COALESCE(m.appl_name, '') AS appl_name,
  CASE WHEN m.bundle IS NULL THEN '' ELSE m.app_detail END AS app_detail,
  COALESCE(m.app_cat, 'Not Found') AS app_cat, COALESCE(m.app_rank, '') AS app_rank,
  COALESCE(m.app_age_grp, '') AS app_age_grp, COALESCE(m.app_age_grp2, '') AS app_age_grp2
FROM r_pending p LEFT JOIN v_metadata m ON p.bundle = m.bundle"""
VIEWS["r_base"] = """
SELECT bundle, app_url, appl_name AS name, upper(app_cat) AS app_cat, app_detail, app_rank,
  app_age_grp, app_age_grp2, unique_ifa, '19950101-20021231' AS source,
  '01/03/2000' AS last_update,
  CASE WHEN regexp_full_match(bundle, '[0-9]+') THEN 'IOS' ELSE 'ANDROID' END AS platform
FROM r_results"""
VIEWS["r_totals"] = _totals("r_base")
VIEWS["r_segmented"] = _segmented("r_base", "r_totals")
VIEWS["r_refreshed"] = _refreshed("r_segmented", "fx_old_list")
VIEWS["r_merged"] = _merged("fx_old_list", "r_refreshed")
VIEWS.update(_refined("r_cleaned", "r_merged"))
VIEWS["r_table"] = _persona_table("r_cleaned")

# ---- statements ------------------------------------------------------------

_METADATA_FIELDS = ", ".join(fixed.METADATA_FIELDS)


def _keyword_hits() -> str:
    lists = {
        "budget": fixed.BUDGET_WORDS,
        "wealth": fixed.WEALTH_WORDS,
        "entertainment": fixed.ENTERTAINMENT_WORDS,
        "fitness": fixed.FITNESS_WORDS,
        "phone": fixed.PHONE_WORDS,
    }
    return ", ".join(
        f"({' OR '.join(f'contains({c}, {_text(w)})' for c in ('text', 'source') for w in words)}) "
        f"AS {name}"
        for name, words in lists.items()
    )


STATEMENTS = {
    "sightings_exploded": "SELECT * FROM fx_sightings",
    "sightings_pruned": f"""
SELECT * FROM fx_sightings
WHERE date BETWEEN '20000201' AND '20000229' AND country IN ({_COUNTRIES})""",
    "missing_partitions": f"""
SELECT c.country, strftime(d.day, '%Y%m%d') AS date
FROM (SELECT unnest([{_COUNTRIES}]) AS country) c
CROSS JOIN (SELECT unnest(generate_series(DATE '1995-01-01', DATE '2002-12-31',
  INTERVAL 1 DAY)) AS day) d
WHERE (c.country, strftime(d.day, '%Y%m%d')) NOT IN (SELECT (country, date) FROM fx_records)""",
    "unique_devices": "SELECT * FROM v_devices",
    "unique_devices_by_day": "SELECT * FROM v_devices",
    "known_apps": "SELECT * FROM v_known",
    "known_apps_file": "SELECT * FROM v_known",
    "sightings_by_path": f"""
SELECT * FROM fx_sightings
WHERE date BETWEEN '19950101' AND '20021231' AND country IN ({_COUNTRIES})""",
    "sightings_from_table": f"""
SELECT * FROM fx_sightings
WHERE date BETWEEN '20000201' AND '20000229' AND country IN ({_COUNTRIES})""",
    "unknown_apps": "SELECT * FROM v_unknown",
    "unknown_apps_large_list": "SELECT * FROM v_unknown",
    "union_of_countries": "SELECT bundle, unique_ifa FROM v_unknown_selected",
    "audience_threshold": "SELECT * FROM v_audience",
    "largest_audiences": "SELECT * FROM v_unknown",
    "first_audience": """
SELECT * FROM v_audience ORDER BY unique_ifa DESC, bundle ASC NULLS FIRST LIMIT 1""",
    "resume_pending": """
SELECT * FROM v_audience a WHERE NOT EXISTS (SELECT 1 FROM fx_done d WHERE d.bundle = a.bundle)""",
    "resume_pending_bucketed": """
SELECT * FROM v_audience WHERE bundle IS NULL OR bundle NOT IN (SELECT bundle FROM fx_done)""",
    "batch_numbers": "SELECT * FROM v_batched",
    "batch_summary": """
SELECT grp, count(*) AS apps, min(bundle) AS first_bundle, max(bundle) AS last_bundle,
  CAST(sum(unique_ifa) AS BIGINT) AS unique_ifa FROM v_batched_50 GROUP BY grp""",
    "batch_count": "SELECT COALESCE(max(grp), 0) AS batches FROM v_batched",
    "one_batch": "SELECT * FROM v_batched_50 WHERE grp = 2",
    "lookup_metadata": f"SELECT bundle, {_METADATA_FIELDS} FROM v_lookup",
    "store_a_metadata": f"SELECT bundle, {_METADATA_FIELDS} FROM v_store_a",
    "store_b_metadata": f"SELECT bundle, {_METADATA_FIELDS} FROM v_store_b",
    "metadata_fallback": f"SELECT bundle, {_METADATA_FIELDS} FROM v_metadata",
    "batch_metadata": f"""
SELECT b.bundle, b.unique_ifa, b.rn, b.grp, {
        ", ".join(
            f"CASE WHEN m.bundle IS NULL THEN '{fixed.NOT_FOUND if f == 'app_cat' else ''}' "
            f"ELSE m.{f} END AS {f}" for f in fixed.METADATA_FIELDS
        )
    } FROM v_batched b LEFT JOIN v_metadata m ON b.bundle = m.bundle""",
    "batch_metadata_large_list": f"""
SELECT b.bundle, b.unique_ifa, b.rn, b.grp, {
        ", ".join(
            f"CASE WHEN m.bundle IS NULL THEN '{fixed.NOT_FOUND if f == 'app_cat' else ''}' "
            f"ELSE m.{f} END AS {f}" for f in fixed.METADATA_FIELDS
        )
    } FROM v_batched b LEFT JOIN v_metadata m ON b.bundle = m.bundle""",
    "batch_append": f"""
SELECT b.bundle, CAST(b.unique_ifa AS DOUBLE) AS unique_ifa, {
        ", ".join(
            f"CASE WHEN m.bundle IS NULL THEN '{fixed.NOT_FOUND if f == 'app_cat' else ''}' "
            f"ELSE m.{f} END AS {f}" for f in fixed.METADATA_FIELDS
        )
    } FROM v_batched b LEFT JOIN v_metadata m ON b.bundle = m.bundle""",
    "page_titles": f"""
SELECT page_id, {_inner("page", "<title>", "title")} AS title,
  {_inner("page", "<h1>", "h1")} AS heading,
  regexp_extract(page, '<html lang="([^"]*)"', 1) AS lang
FROM (SELECT page_id, {_COMMENTLESS.format("html")} AS page FROM pages)""",
    "app_base": "SELECT * FROM v_base",
    "platforms": """
SELECT bundle, CASE WHEN bundle IS NULL THEN NULL WHEN bundle <> ''
  AND length(ltrim(bundle, '0123456789')) = 0 THEN 'IOS' ELSE 'ANDROID' END AS platform
FROM fx_new_list""",
    "segment_join": "SELECT * EXCLUDE (segment_index, ifa_cnt) FROM v_segmented",
    "segment_join_large_reference": """
SELECT b.bundle, b.app_cat, b.unique_ifa, r.store_cat, r.segment_grp
FROM v_base b LEFT JOIN fx_ref_app r ON b.app_cat = r.app_cat""",
    "persona_index_join": "SELECT * EXCLUDE (ifa_cnt) FROM v_segmented",
    "bundle_totals": """
SELECT b.bundle, b.unique_ifa, t.ifa_cnt FROM v_base b LEFT JOIN v_totals t USING (bundle)""",
    "segmented_list": "SELECT * FROM v_segmented",
    "segment_group_count": """
SELECT count(DISTINCT segment_grp_1) + max(CASE WHEN segment_grp_1 IS NULL THEN 1 ELSE 0 END)
  AS distinct_values FROM fx_persona_list""",
    "segment_index_reference": """
SELECT segment_grp_1, segment_index FROM fx_old_list WHERE segment_index IS NOT NULL GROUP BY 1, 2""",
    "repeated_reference_keys": """
SELECT segment_grp_1, count(DISTINCT segment_index) AS occurrences FROM fx_old_list
WHERE segment_index IS NOT NULL GROUP BY 1 HAVING count(DISTINCT segment_index) > 1""",
    "refresh_segment_index": "SELECT * FROM v_refreshed",
    "stacked_lists": f"""
SELECT {MASTER_COLUMNS} FROM fx_old_list UNION ALL SELECT {MASTER_COLUMNS} FROM v_refreshed""",
    "merged_list": "SELECT * FROM v_merged",
    "merged_list_in_parts": "SELECT * FROM v_merged",
    **{
        f"rule_{rule.name}": "SELECT bundle, app_name, details, segment_grp, segment_grp_1 "
        f"FROM ({_rule(rule, 'fx_persona_list')})"
        for rule in SEGMENT_RULES
    },
    "refined_segments": "SELECT * FROM v_refined",
    "cleaned_list": "SELECT * FROM v_cleaned",
    "document_keywords": f"SELECT doc_id, {_keyword_hits()} FROM documents",
    "persona_names": f"""
SELECT bundle, segment_grp_1, a.persona, b.persona AS second_persona
FROM ({_persona("fx_persona_list", True)}) a
JOIN (SELECT bundle, persona FROM ({_persona("fx_persona_list", False)})) b USING (bundle)""",
    "persona_ranks": f"""
SELECT bundle, segment_grp_1, rank FROM ({_persona("fx_persona_list", True)})""",
    "category_primary": f"""
SELECT bundle, category, CASE WHEN category IS NULL THEN '{fixed.NOT_FOUND}' ELSE
  (SELECT arg_min(m.value, m.pos) FROM map_category m WHERE p.category LIKE m.key) END
  AS app_category FROM fx_persona_list p""",
    "category_second": """
SELECT p.bundle, p.category, t.value AS app_category
FROM fx_persona_list p JOIN map_second t ON p.category = t.key""",
    "persona_table": "SELECT * FROM v_persona_table",
    "persona_view_rows": _persona_view("v_persona_table"),
    "reporting_month": """
SELECT strftime(d, '%Y%m%d') AS run_day,
  strftime(date_trunc('month', d) - INTERVAL 1 MONTH, '%Y%m%d') AS start_date,
  strftime(date_trunc('month', d) - INTERVAL 1 DAY, '%Y%m%d') AS end_date,
  strftime(d, '%Y%m') AS run_label,
  strftime(d - INTERVAL 30 DAY, '%Y%m') AS lookback_month_id,
  strftime(d - INTERVAL 30 DAY, '%Y') AS lookback_year,
  strftime(d - INTERVAL 30 DAY, '%m') AS lookback_month,
  strftime(d, '%d/%m/%Y') AS last_update,
  strftime(date_trunc('month', d) - INTERVAL 1 MONTH, '%Y%m%d') || '-' ||
    strftime(date_trunc('month', d) - INTERVAL 1 DAY, '%Y%m%d') AS source
FROM (SELECT DISTINCT CAST(o_orderdate AS DATE) AS d FROM orders)""",
    "csv_roundtrip": "SELECT bundle, unique_ifa FROM v_unknown",
    "csv_reference": f"""
SELECT {", ".join(c if c == "ifa_cnt" else f"NULLIF({c}, '') AS {c}" for c in _COLUMNS)}
FROM fx_persona_list""",
    "json_append": "SELECT * FROM fx_metadata",
    "json_batches": "SELECT * FROM v_batched",
    "parquet_roundtrip": "SELECT * FROM fx_persona_list",
    "sightings_by_country": f"SELECT * FROM fx_sightings WHERE country IN ({_COUNTRIES})",
    "versioned_overwrite": "SELECT * FROM v_cleaned",
    "publish_table": _persona_view("v_persona_table"),
    "monthly_refresh_view": _persona_view("r_table"),
}


def statements() -> dict[str, str]:
    return {name: with_inputs(body.strip(), VIEWS) for name, body in STATEMENTS.items()}
