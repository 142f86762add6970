"""The result of each query in plain SQL, for an independent engine.

The SQL states results from the base tables; it shares only the derived inputs
with the Spark queries.
"""

from __future__ import annotations

from strata.functions.codes import BASE_CODE_PATTERN
from workload import inputs
from workload.inputs import TABLES, oracle_text
from workload.jobs import (
    EDUCATION_SOURCE,
    INDUSTRY_SOURCE,
    MATRIX_COVERAGE_SOURCE,
    OBSERVATION_SOURCE,
    RELATED_SOURCE,
    SOFTWARE_SOURCE,
    TASK_SOURCE,
    ZONE_SOURCE,
)

TOKENS = "('','—','–','-','n/a','na','null')"
DIRTY = ("o_orderkey", "raw_code", "raw_amount", "raw_flag", "raw_month", "raw_zone")


def text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def cleaned(column: str) -> str:
    return f"CASE WHEN lower(trim({column})) IN {TOKENS} THEN NULL ELSE trim({column}) END"


def stripped(column: str) -> str:
    return rf"regexp_replace({column},'^\s+|\s+$','','g')"


def digits(column: str) -> str:
    return f"regexp_replace({column},'[^0-9]','','g')"


def base(column: str) -> str:
    d = digits(column)
    return f"CASE WHEN length({d})>=6 THEN substr({d},1,2)||'-'||substr({d},3,4) END"


def detail(column: str) -> str:
    s = stripped(column)
    return (
        f"CASE WHEN regexp_full_match({s},'[0-9]{{2}}-[0-9]{{4}}\\.[0-9]{{2}}') "
        f"THEN {s} END"
    )


def flag(column: str) -> str:
    s = f"lower({stripped(column)})"
    return (
        f"CASE WHEN {s} IN ('y','yes','true','t','1') THEN TRUE "
        f"WHEN {s} IN ('n','no','false','f','0') THEN FALSE END"
    )


def compact(column: str) -> str:
    return rf"regexp_replace(trim({column}),'\s+','','g')"


# What a mark before an amount means.
BOUNDS = """(VALUES ('≥','greater_than_or_equal'), ('>=','greater_than_or_equal'),
  ('≤','less_than_or_equal'), ('<=','less_than_or_equal'),
  ('<','less_than'), ('>','greater_than')) AS bound(mark, meaning)"""


def longest_mark(column: str, what: str) -> str:
    """Of the marks that an amount begins with, the longest one's attribute."""
    return (
        f"(SELECT max_by({what}, length(mark)) FROM {BOUNDS} "
        f"WHERE starts_with({compact(column)}, mark))"
    )


def qualifier(column: str) -> str:
    return f"if({column} IS NULL, NULL, coalesce({longest_mark(column, 'meaning')}, 'exact'))"


def amount_text(column: str) -> str:
    start = f"1 + coalesce({longest_mark(column, 'length(mark)')}, 0)"
    return f"replace(replace(substr({compact(column)}, {start}), ',', ''), '$', '')"


def whole(column: str, type_name: str) -> str:
    """Integer cast guarded by a pattern: engines differ on '2.5' and '1e3'."""
    c = f"regexp_replace(trim({column}),'[$,%]','','g')"
    return (
        f"CASE WHEN regexp_full_match({c},'[+-]?[0-9]+') "
        f"THEN CAST({c} AS {type_name}) END"
    )


def month(column: str) -> str:
    return f"CAST(try_strptime('01/'||{column},'%d/%m/%Y') AS DATE)"


# Every known period with its type and the month it starts in.
CALENDAR = """calendar AS (
  SELECT format('M{:02d}', m) AS period, 'monthly' AS kind, m AS first_month
  FROM range(1, 13) AS months(m)
  UNION ALL VALUES ('M13', 'annual', 1), ('A01', 'annual', 1),
                   ('S01', 'semiannual', 1), ('S02', 'semiannual', 7))"""


def key(*parts: str) -> str:
    marked = [f"coalesce(CAST({p} AS VARCHAR),'<null>')" for p in parts]
    return "concat_ws('|'," + ",".join(marked) + ")"


def row_hash(*columns: str) -> str:
    marked = [f"coalesce(CAST({c} AS VARCHAR),'<null>')" for c in sorted(columns)]
    return "sha256(concat_ws('||'," + ",".join(marked) + "))"


def with_tables(*names: str) -> str:
    """WITH clause that names the derived clean tables."""
    return "WITH " + ", ".join(
        f"{n} AS ({oracle_text(inputs.CLEAN_TABLES[n])})" for n in names
    )


DIRTY_ORDERS = oracle_text(inputs.DIRTY_ORDERS)
DIRTY_LINEITEM = oracle_text(inputs.DIRTY_LINEITEM)
CLEANED_ORDERS = (
    "SELECT o_orderkey, "
    + ", ".join(f"{cleaned(c)} AS {c}" for c in DIRTY[1:])
    + f" FROM ({DIRTY_ORDERS})"
)

# Order rows before and after the casts.
ORDER_ROWS = f"""
WITH c AS (SELECT o_orderkey, {", ".join(f"{cleaned(c)} AS {c}" for c in DIRTY[1:])}
           FROM ({oracle_text(inputs.REPEATED_ORDERS)})),
r AS (SELECT o_orderkey AS order_key, raw_code AS code_raw, {base('raw_code')} AS code,
             {amount_text('raw_amount')} AS amount, raw_amount AS amount_raw,
             {qualifier('raw_amount')} AS amount_qualifier, {flag('raw_flag')} AS flag,
             {month('raw_month')} AS month, raw_zone AS zone FROM c),
t AS (SELECT order_key, code_raw, code, amount AS amount_text,
             {whole('amount', 'BIGINT')} AS amount, amount_raw, amount_qualifier, flag,
             month, zone AS zone_text, {whole('zone', 'INTEGER')} AS zone FROM r)
"""
ORDER_COLUMNS = (
    "amount",
    "amount_qualifier",
    "amount_raw",
    "code",
    "code_raw",
    "flag",
    "month",
    "order_key",
    "zone",
)
KEPT_ORDERS = f"""{ORDER_ROWS},
v AS (SELECT {", ".join(ORDER_COLUMNS)}, {row_hash(*ORDER_COLUMNS)} AS h
      FROM t WHERE code IS NOT NULL AND amount IS NOT NULL),
k AS (SELECT *, row_number() OVER (PARTITION BY code, zone ORDER BY h) AS rn FROM v)
"""


def issue(
    dataset: str, record_key: str, severity: str, rule: str, message: str, raw: str
) -> str:
    """Select list of an issue row; arguments are SQL expressions."""
    return f"""SELECT 'run-1' AS run_id, 'tables' AS source_system,
      {text(dataset)} AS dataset_name, {text(dataset + '.parquet')} AS source_file_path,
      {record_key} AS record_key, {severity} AS severity, {rule} AS rule_name,
      {message} AS issue_message, {raw} AS raw_value"""


def required_issue(column: str, record_key: str) -> str:
    return issue(
        "orders",
        record_key,
        "'error'",
        "'missing_required_value'",
        text(f"{column!r} must have a value."),
        text(column),
    )


def cast_issue(column: str, type_name: str, record_key: str, raw: str) -> str:
    return issue(
        "orders",
        record_key,
        "'error'",
        "'invalid_type_cast'",
        text(f"The value of {column!r} is no {type_name!r}."),
        raw,
    )


def regex_issue(record_key: str, severity: str) -> str:
    return issue(
        "orders",
        record_key,
        text(severity),
        "'invalid_format'",
        text(
            f"The value of 'code_raw' is not of the form {BASE_CODE_PATTERN!r}."
        ),
        "code_raw",
    )


MISSING_COLUMN = issue(
    "orders",
    "NULL",
    "'error'",
    "'missing_required_column'",
    text("The source has no column 'approved_by'."),
    "'approved_by'",
)
BAD_CODE = r"code_raw IS NOT NULL AND NOT regexp_matches(code_raw,'^\d{2}-\d{4}$')"
BAD_AMOUNT = "amount_text IS NOT NULL AND amount IS NULL"
BAD_ZONE = "zone_text IS NOT NULL AND zone IS NULL"

_STAR_TABLES = (
    "bls_oews_observations",
    "bls_oews_series",
    "bls_oews_occupations",
    "bls_oews_areas",
    "bls_oews_industries",
    "bls_oews_datatypes",
)
# All names of codes in one relation, whatever they are codes of.
_NAMES = " UNION ALL ".join(
    f"SELECT '{kind}' AS kind, {kind}_code AS code, {other} AS other, "
    f"max({kind}_name) AS name, count(*) AS n FROM bls_oews_{table} GROUP BY {kind}_code"
    for kind, table, other in (
        ("occupation", "occupations", "max(soc_code)"),
        ("area", "areas", "NULL"),
        ("industry", "industries", "NULL"),
        ("datatype", "datatypes", "NULL"),
    )
)


def named(kind: str, what: str = "name") -> str:
    return (
        f"(SELECT names.{what} FROM names "
        f"WHERE names.kind='{kind}' AND names.code=s.{kind}_code)"
    )


STAR_FACT = f"""{with_tables(*_STAR_TABLES)}, {CALENDAR}, names AS ({_NAMES}),
described AS (
  SELECT s.* EXCLUDE (soc_code), {named('area')} AS area_name,
    {named('area', 'n')} AS area_lookup_record_count,
    {named('datatype')} AS datatype_name, {named('industry')} AS industry_name,
    {named('occupation')} AS occupation_name,
    coalesce(s.soc_code, {named('occupation', 'other')}) AS soc_code
  FROM bls_oews_series s),
fact AS (
  SELECT described.*, m.year, m.period, m.value, m.value_raw, m.footnote_codes,
    coalesce(kind, 'other') AS period_type,
    make_date(m.year, first_month, 1) AS observation_date
  FROM described JOIN bls_oews_observations m USING (series_id)
  LEFT JOIN calendar USING (period)
  WHERE m.value = m.value)
"""

PROJECTION_FACT = f"""{with_tables('bls_employment_projections')},
fact AS (
  SELECT soc_code, occupation_title, occupation_type,
    2024 AS projection_base_year, 2034 AS projection_target_year,
    employment_base_year_thousands, employment_projected_year_thousands,
    employment_change_thousands, annual_openings_thousands,
    CAST(round(employment_base_year_thousands*1000) AS BIGINT) AS employment_base_year,
    CAST(round(employment_projected_year_thousands*1000) AS BIGINT)
      AS employment_projected_year,
    CAST(round(employment_change_thousands*1000) AS BIGINT) AS employment_change,
    CAST(round(annual_openings_thousands*1000) AS BIGINT) AS annual_openings,
    employment_change_percent,
    coalesce((['declining', 'no_change', 'growing'])
      [2 + CAST(sign(employment_change_percent) AS INT)], 'unknown') AS growth_direction,
    employment_distribution_base_percent, employment_distribution_projected_percent,
    percent_self_employed, median_annual_wage, median_annual_wage_raw,
    median_annual_wage_qualifier, typical_entry_education, related_work_experience,
    on_the_job_training
  FROM bls_employment_projections
  WHERE regexp_full_match(soc_code,'[0-9]{{2}}-[0-9]{{4}}')),
board AS (SELECT * FROM fact WHERE occupation_type = 'Line item')
"""

SKILLS = f"""{with_tables(
    'onet_essential_skills', 'onet_transferable_skills', 'onet_occupations')},
u AS (SELECT 'essential' AS skill_family, * FROM onet_essential_skills
      WHERE data_value IS NOT NULL
      UNION ALL
      SELECT 'transferable', * FROM onet_transferable_skills
      WHERE data_value IS NOT NULL)
SELECT u.onet_soc_code, u.soc_code, o.occupation_title, u.skill_family,
  u.element_id AS skill_id, u.element_name AS skill_name, u.scale_id,
  CASE upper(u.scale_id) WHEN 'IM' THEN 'importance' WHEN 'LV' THEN 'level'
       ELSE lower(u.scale_id) END AS scale_name,
  u.data_value AS skill_score,
  CAST(dense_rank() OVER (PARTITION BY u.onet_soc_code, u.skill_family, u.scale_id
    ORDER BY u.data_value DESC, u.element_name) AS INTEGER) AS skill_rank
FROM u LEFT JOIN onet_occupations o ON u.onet_soc_code = o.onet_soc_code
"""

_DIMENSION_SOURCES = {
    "bls_employment_projections": ("occupation_title", "NULL"),
    "bls_oews_occupations": ("occupation_name", "NULL"),
    "onet_occupations": ("occupation_title", "onet_soc_code"),
}


def dimension(
    sources: dict[str, str],
    flags: dict[str, str],
    counted: str,
    title: str,
    count_name: str,
) -> str:
    """Dimension over sources given as selects of (soc_code, title, member)."""
    order = list(sources)
    stacked = " UNION ALL ".join(
        f"SELECT {place} AS place, soc_code, title, CAST(member AS VARCHAR) AS member "
        f"FROM ({sources[name]})"
        for place, name in enumerate(order)
    )
    present = ", ".join(
        f"list_contains(places, {order.index(name)}) AS {f}" for f, name in flags.items()
    )
    return f"""coded AS (SELECT *, left(soc_code, 2) AS prefix FROM ({stacked})
      WHERE regexp_full_match(soc_code, '[0-9]{{2}}-[0-9]{{4}}')),
    best AS (SELECT soc_code, title FROM coded WHERE title IS NOT NULL
      QUALIFY row_number() OVER (PARTITION BY soc_code ORDER BY place, title DESC) = 1),
    found AS (SELECT soc_code, prefix, list(DISTINCT place) AS places,
        count(DISTINCT member) FILTER (WHERE place = {order.index(counted)}) AS members
      FROM coded GROUP BY soc_code, prefix)
    SELECT soc_code, title AS {title}, concat(prefix, '-0000') AS major_group_code,
      max(title) FILTER (WHERE right(soc_code, 4) = '0000') OVER (PARTITION BY prefix)
        AS major_group_title, members AS {count_name}, {present}
    FROM found LEFT JOIN best USING (soc_code)"""


OCCUPATION_DIMENSION = (
    with_tables(*_DIMENSION_SOURCES)
    + ", "
    + dimension(
        {
            n: f"SELECT soc_code, {t} AS title, {m} AS member FROM {n}"
            for n, (t, m) in _DIMENSION_SOURCES.items()
        },
        {
            "has_employment_projection_data": "bls_employment_projections",
            "has_oews_data": "bls_oews_occupations",
            "has_onet_data": "onet_occupations",
        },
        "onet_occupations",
        "occupation_title",
        "onet_occupation_count",
    )
)


def facet(name: str, passes: str) -> str:
    return (
        f"SELECT {text(name)} AS facet, {name} AS value, "
        f"count(*) FILTER (WHERE {passes}) AS matching_rows FROM board GROUP BY {name}"
    )


_GROWTH = "growth_direction IN ('growing','unknown')"
_EDUCATION = (
    "(typical_entry_education IN ('Brand#11','Brand#2') "
    "OR typical_entry_education IS NULL)"
)

OBSERVED = oracle_text(OBSERVATION_SOURCE)
ZONED = oracle_text(ZONE_SOURCE)
GOOD_ZONE = "code<>'none' AND job_zone<>'2.5'"


def counted(table_name: str, entry: str, source: str, condition: str, what: str = "*") -> str:
    """A row with the number of source rows, or of different codes, that fulfil it."""
    return (
        f"SELECT '{table_name}' AS table_name, '{entry}' AS entry, "
        f"count({what}) AS n_rows FROM ({source}) WHERE {condition}"
    )


def _job_log() -> str:
    seen, zones = "bls_oews_observations", "onet_job_zones"
    # A code that is none at all lacks both of its forms; a zone that is no number is one.
    lacking = (
        f"SELECT '{zones}' AS table_name, 'missing_required_value' AS entry, "
        f"sum(CASE WHEN code='none' THEN 2 ELSE 0 END"
        f" + CASE WHEN job_zone='2.5' THEN 1 ELSE 0 END)::BIGINT AS n_rows FROM ({ZONED})"
    )
    repeated = (
        f"SELECT '{{}}' AS table_name, 'exact_duplicate_key' AS entry, count(*) AS n_rows "
        f"FROM (SELECT {{}} FROM ({{}}) WHERE {{}} GROUP BY ALL HAVING count(*)>1)"
    )
    return " UNION ALL ".join(
        [
            counted(seen, "missing_required_value", OBSERVED, "series_id='N/A'"),
            counted(seen, "invalid_format", OBSERVED, "period='late'"),
            counted(seen, "invalid_type_cast", OBSERVED, "value='abc'"),
            repeated.format(seen, "series_id, year, period", OBSERVED, "series_id<>'N/A'"),
            counted(
                seen, "success overwrite", OBSERVED, "series_id<>'N/A'",
                "DISTINCT (series_id, year, period)",
            ),
            lacking,
            counted(zones, "invalid_format", ZONED, "code='none'"),
            counted(zones, "invalid_type_cast", ZONED, "job_zone='2.5'"),
            counted(zones, "invalid_job_zone", ZONED, "job_zone IN ('0','6','7')"),
            repeated.format(zones, "code", ZONED, GOOD_ZONE),
            counted(zones, "success overwrite", ZONED, GOOD_ZONE, "DISTINCT code"),
        ]
    )


RAGGED = """
    WITH ragged AS (
      SELECT CAST(o_orderkey AS VARCHAR) AS o_orderkey, CAST(o_custkey AS VARCHAR) AS o_custkey,
        CASE WHEN o_orderkey%10<>1 THEN o_orderstatus END AS o_orderstatus,
        CASE o_orderkey%10 WHEN 1 THEN concat_ws(chr(9), o_orderkey, o_custkey)
          WHEN 2 THEN concat_ws(chr(9), o_orderkey, o_custkey, o_orderstatus, 'more')
        END AS row_text
      FROM orders)
"""

ORACLES: dict[str, str] = {
    "job_observations": f"""
        SELECT DISTINCT series_id, CAST(year AS INT) AS year, period, value AS value_raw,
          nullif(footnote_codes,'-') AS footnote_codes, TRY_CAST(value AS DOUBLE) AS value
        FROM ({OBSERVED}) WHERE series_id<>'N/A'""",
    "job_zones": f"""
        SELECT DISTINCT code AS onet_soc_code_raw, code AS onet_soc_code,
          substr(code,1,7) AS soc_code, CAST(job_zone AS INT) AS job_zone,
          date AS source_date_raw, {month('date')} AS data_month, domain_source
        FROM ({ZONED}) WHERE {GOOD_ZONE}""",
    "job_log": _job_log(),
    "job_log_repeated": _job_log(),
    "job_all_or_none": f"""
        WITH n AS (
          SELECT 'bls_oews_observations' AS table_name,
            count(DISTINCT (series_id, year, period)) AS n_rows
          FROM ({OBSERVED}) WHERE series_id<>'N/A'
          UNION ALL SELECT 'onet_job_zones', count(DISTINCT code) FROM ({ZONED}) WHERE {GOOD_ZONE})
        SELECT table_name, e.entry, CASE WHEN e.entry='run-2 withdrawn' THEN 0 ELSE n_rows END AS n_rows
        FROM n, (VALUES ('rows'), ('run-1 success'), ('run-2 withdrawn')) AS e(entry)
        UNION ALL SELECT 't', 'run-2 failed', NULL""",
    "published_view": f"""{PROJECTION_FACT}
        SELECT * FROM fact UNION ALL SELECT * FROM fact""",
    "job_failure": f"""
        SELECT 'bls_oews_observations' AS table_name, 'success' AS status,
          count(DISTINCT (series_id, year, period)) AS row_count, false AS has_error
        FROM ({OBSERVED}) WHERE series_id<>'N/A'
        UNION ALL SELECT 't', 'failed', NULL, true""",
    "scan_delimited": """
        SELECT CAST(o_orderkey AS VARCHAR) AS o_orderkey,
          CAST(o_custkey AS VARCHAR) AS o_custkey, o_orderstatus,
          CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS o_orderday, o_orderpriority
        FROM orders""",
    "scan_ragged": f"{RAGGED} SELECT * FROM ragged",
    "issues_malformed": f"""{RAGGED}
        SELECT 'row' AS entry, o_orderkey AS record_key, o_orderstatus AS raw_value FROM ragged
        UNION ALL SELECT 'malformed_row', o_orderkey, row_text FROM ragged
        WHERE row_text IS NOT NULL""",
    "header_offset_read": """
        SELECT CAST(c_custkey AS VARCHAR) AS c_custkey,
          c_name || CASE WHEN c_custkey%10=3
            THEN chr(10) || chr(10) || 'the "second" line' ELSE '' END AS c_name,
          CAST(c_nationkey AS VARCHAR) AS c_nationkey, c_mktsegment FROM customer""",
    "file_manifest": " UNION ALL ".join(
        f"SELECT '{n}' AS table_name, count(*) AS n_rows, true AS all_have_content FROM {n}"
        for n in TABLES
    ),
    "required_source_gate": " UNION ALL ".join(
        f"SELECT '' AS source_group, '{n}.parquet' AS file_name, "
        f"'success' AS download_status, count(*) AS n_rows, false AS stops_the_run FROM {n}"
        for n in TABLES
    )
    + """ UNION ALL SELECT * FROM (VALUES
        ('', 'returns.parquet', 'failed', NULL::BIGINT, true),
        ('', 'notes.parquet', 'failed', NULL::BIGINT, false),
        ('other', 'orders.parquet', 'failed', NULL::BIGINT, true))""",
    "sink_overwrite_append": """
        SELECT event_type, 2*count(*) AS n_rows FROM events GROUP BY event_type""",
    "json_flatten": """
        SELECT event_id, CAST(json_extract(props,'$.k') AS BIGINT) AS k FROM events""",
    "series_flatten": """
        SELECT event_type AS series_id, strftime(ts,'%Y') AS year, p.period,
          CAST(CASE p.period WHEN 'M01' THEN event_id ELSE user_id END AS VARCHAR)
            AS value, '1,2' AS footnote_codes
        FROM events, (VALUES ('M01'),('M02')) AS p(period) WHERE event_id%7<>0""",
    "latest_per_series": """
        SELECT user_id, event_id, event_type FROM (
          SELECT *, row_number() OVER (PARTITION BY user_id
            ORDER BY ts DESC, event_id DESC) AS rn FROM events) WHERE rn=1""",
    "normalize_headers": """
        SELECT p_partkey AS ppart_key, p_name AS name_full_text,
          p_brand AS brand_label_2, p_size AS size FROM part""",
    "trim_and_nullify": CLEANED_ORDERS,
    "lineage_columns": """
        SELECT l_orderkey, l_linenumber, 'lineitem' AS source_file_path,
          'run-1' AS run_id FROM lineitem""",
    "mapped_projection": """
        SELECT c_name AS name, c_custkey AS key, c_mktsegment AS segment,
          c_mktsegment AS segment_raw FROM customer""",
    "required_filter": f"""
        SELECT o_orderkey, raw_code, raw_amount FROM ({CLEANED_ORDERS})
        WHERE raw_code IS NOT NULL AND raw_amount IS NOT NULL""",
    "base_frame": f"""
        SELECT CAST(o_orderkey AS VARCHAR) AS orderkey, raw_code, raw_amount, raw_flag,
          raw_month, raw_zone, 'orders' AS source_file_path, 'run-1' AS run_id
        FROM ({CLEANED_ORDERS})""",
    "normalize_base_code": f"""
        SELECT o_orderkey, raw_code, {base('raw_code')} AS code FROM ({DIRTY_ORDERS})""",
    "normalize_detail_code": f"""
        SELECT o_orderkey, raw_code, {detail('raw_code')} AS detail,
          {base('raw_code')} AS base FROM ({DIRTY_ORDERS})""",
    "yes_no_flag": f"""
        SELECT o_orderkey, {flag('raw_flag')} AS flag FROM ({DIRTY_ORDERS})""",
    "amount_qualifier": f"""
        SELECT o_orderkey, raw_amount, {qualifier('raw_amount')} AS qualifier,
          {whole(amount_text('raw_amount'), 'BIGINT')} AS amount
        FROM ({CLEANED_ORDERS})""",
    "safe_cast": f"""
        SELECT o_orderkey, {whole('raw_amount', 'BIGINT')} AS amount,
          raw_amount IS NOT NULL AND {whole('raw_amount', 'BIGINT')} IS NULL
            AS is_failure
        FROM ({DIRTY_ORDERS})""",
    "source_month": f"""
        SELECT o_orderkey, raw_month, {month('raw_month')} AS data_month
        FROM ({DIRTY_ORDERS})""",
    "period_calendar": f"""
        WITH {CALENDAR}
        SELECT o_orderkey, period, coalesce(kind, 'other') AS period_type,
          make_date(yr, first_month, 1) AS observation_date
        FROM ({oracle_text(inputs.PERIODS)}) LEFT JOIN calendar USING (period)""",
    "thousands_to_count": """
        SELECT p_partkey, CAST(round(p_retailprice*1000) AS BIGINT) AS units FROM part""",
    "direction_label": """
        WITH c AS (SELECT c_mktsegment, CAST(round(c_acctbal*100) AS BIGINT) AS cents
                   FROM customer),
        m AS (SELECT c_mktsegment, sum(cents)/count(cents) AS mean FROM c GROUP BY 1)
        SELECT c_mktsegment, CASE WHEN cents-mean > 0 THEN 'growing'
          WHEN cents-mean < 0 THEN 'declining' WHEN cents-mean = 0 THEN 'no_change'
          ELSE 'unknown' END AS label, count(*) AS n
        FROM c JOIN m USING (c_mktsegment) GROUP BY 1, 2""",
    "level_label": """
        SELECT CASE p_size%7 WHEN 1 THEN 'little_or_no_preparation'
            WHEN 2 THEN 'some_preparation' WHEN 3 THEN 'medium_preparation'
            WHEN 4 THEN 'high_preparation' WHEN 5 THEN 'extensive_preparation'
            ELSE 'unknown' END AS zone_label,
          CASE WHEN p_size%7<2 THEN 'importance' WHEN p_size%7<4 THEN 'level'
            ELSE 'cx' END AS scale_name, count(*) AS n
        FROM part GROUP BY 1, 2""",
    "record_key": f"""
        SELECT o_orderkey, {key('o_orderkey', 'raw_code', 'raw_flag')} AS record_key
        FROM ({CLEANED_ORDERS})""",
    "row_hash": f"""
        SELECT l_orderkey, l_linenumber, {row_hash('l_orderkey', 'l_linenumber',
          'l_partkey', 'l_suppkey', 'cents', 'l_returnflag')} AS row_hash
        FROM ({DIRTY_LINEITEM})""",
    "issues_required": f"""{ORDER_ROWS}
        {required_issue('code', key('order_key'))} FROM r WHERE code IS NULL
        UNION ALL
        {required_issue('amount', key('order_key'))} FROM r WHERE amount IS NULL
        UNION ALL {MISSING_COLUMN}""",
    "issues_regex": f"""{ORDER_ROWS}
        {regex_issue(key('order_key'), 'warning')} FROM t WHERE {BAD_CODE}""",
    "issues_cast": f"""{ORDER_ROWS}
        {cast_issue('amount', 'bigint', key('order_key', 'zone_text'), 'amount_text')}
        FROM t WHERE {BAD_AMOUNT}
        UNION ALL
        {cast_issue('zone', 'int', key('order_key', 'zone'), 'zone_text')}
        FROM t WHERE {BAD_ZONE}""",
    "issues_range": issue(
        "part",
        "CAST(p_partkey AS VARCHAR)",
        "'error'",
        "'invalid_size'",
        "'Size must be between 1 and 40.'",
        "CAST(p_size AS VARCHAR)",
    )
    + " FROM part WHERE p_size NOT BETWEEN 1 AND 40",
    "issues_duplicate": f"""
        WITH h AS (SELECT l_orderkey, l_linenumber, {row_hash('l_orderkey',
          'l_linenumber', 'l_partkey', 'l_suppkey', 'cents', 'l_returnflag')} AS h
          FROM ({DIRTY_LINEITEM})),
        g AS (SELECT l_orderkey, l_linenumber, count(*) AS n, count(DISTINCT h) AS v
              FROM h GROUP BY 1, 2 HAVING count(*) > 1)
        {issue('lineitem', key('l_orderkey', 'l_linenumber'),
               "CASE WHEN v>1 THEN 'error' ELSE 'warning' END",
               "CASE WHEN v>1 THEN 'conflicting_duplicate_key' "
               "ELSE 'exact_duplicate_key' END",
               "n||' rows share this business key.'",
               "CAST(n AS VARCHAR)")} FROM g""",
    "dedup_keep_min_hash": f"""
        WITH h AS (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber
          ORDER BY {row_hash('l_orderkey', 'l_linenumber', 'l_partkey', 'l_suppkey',
          'cents', 'l_returnflag')}) AS rn FROM ({DIRTY_LINEITEM}))
        SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, cents, l_returnflag
        FROM h WHERE rn=1""",
    "finish_table": f"""{KEPT_ORDERS}
        SELECT {", ".join(ORDER_COLUMNS)} FROM k WHERE rn=1""",
    "issues_union_summary": f"""{KEPT_ORDERS},
        g AS (SELECT count(*) AS n, count(DISTINCT h) AS versions FROM v
              GROUP BY code, zone HAVING count(*) > 1),
        i AS (
          SELECT 'invalid_type_cast' AS rule_name, 'error' AS severity FROM t
            WHERE {BAD_AMOUNT}
          UNION ALL SELECT 'invalid_type_cast', 'error' FROM t WHERE {BAD_ZONE}
          UNION ALL SELECT 'invalid_format', 'error' FROM t WHERE {BAD_CODE}
          UNION ALL SELECT 'invalid_zone', 'error' FROM t
            WHERE zone NOT BETWEEN 1 AND 5
          UNION ALL SELECT 'missing_required_value', 'error' FROM t WHERE code IS NULL
          UNION ALL SELECT 'missing_required_value', 'error' FROM t
            WHERE amount IS NULL
          UNION ALL SELECT 'missing_required_column', 'error'
          UNION ALL SELECT CASE WHEN versions>1 THEN 'conflicting_duplicate_key'
              ELSE 'exact_duplicate_key' END,
            CASE WHEN versions>1 THEN 'error' ELSE 'warning' END FROM g)
        SELECT rule_name, severity, count(*) AS n_issues FROM i GROUP BY 1, 2""",
    "audit_summary": " UNION ALL ".join(
        f"SELECT 'run-1' AS run_id, 'tables' AS source_system, {text(n)} AS table_name, "
        f"'success' AS status, count(*) AS row_count, 'overwrite' AS write_mode, "
        f"CAST(NULL AS VARCHAR) AS error_message FROM {n}"
        for n in ("orders", "lineitem", "customer")
    ),
    "dimension_build": "WITH "
    + dimension(
        {n: oracle_text(t) for n, t in inputs.PLACES.items()},
        {f"has_{n}_data": n for n in inputs.PLACES},
        "customer",
        "title",
        "customer_count",
    ),
    "occupation_dimension": OCCUPATION_DIMENSION,
    "star_fact": f"{STAR_FACT} SELECT * FROM fact",
    "projection_fact": f"{PROJECTION_FACT} SELECT * FROM fact",
    "bridge_distribution": f"""{with_tables(
        'onet_education', 'onet_education_categories', 'onet_occupations')},
        b AS (SELECT e.onet_soc_code, e.soc_code, o.occupation_title, e.element_id,
            e.element_name, e.scale_id, e.category,
            c.category_description AS education_category,
            e.data_value AS education_response_value,
            CAST(dense_rank() OVER (
              PARTITION BY e.onet_soc_code, e.element_id, e.scale_id
              ORDER BY e.data_value DESC, e.category) AS INTEGER) AS education_rank
          FROM onet_education e
          LEFT JOIN onet_education_categories c USING (element_id, scale_id, category)
          LEFT JOIN onet_occupations o ON e.onet_soc_code = o.onet_soc_code
          WHERE e.data_value IS NOT NULL)
        SELECT *, education_rank = 1 AS is_primary_education_category FROM b""",
    "bridge_family_rank": SKILLS,
    "bridge_family_rank_large_groups": f"""{with_tables(
        'onet_essential_skills', 'onet_transferable_skills')},
        u AS (SELECT 'essential' AS skill_family, * FROM onet_essential_skills
              UNION ALL SELECT 'transferable', * FROM onet_transferable_skills)
        SELECT onet_soc_code, skill_family, element_id AS skill_id, scale_id,
          data_value AS skill_score,
          CAST(dense_rank() OVER (PARTITION BY skill_family, scale_id
            ORDER BY data_value DESC, onet_soc_code, element_id DESC) AS INTEGER)
            AS skill_rank
        FROM u WHERE data_value IS NOT NULL""",
    "rank_hot_group": """
        SELECT l_returnflag, l_orderkey, l_linenumber, l_partkey,
          CAST(dense_rank() OVER (PARTITION BY l_returnflag
            ORDER BY l_partkey DESC, l_linenumber) AS INTEGER) AS rank
        FROM lineitem""",
    "rank_common_prefix": """
        SELECT l_returnflag, l_orderkey, l_linenumber,
          'https://parts.example/' || lpad(CAST(l_partkey AS VARCHAR), 12, '0') AS address,
          CAST(dense_rank() OVER (PARTITION BY l_returnflag
            ORDER BY l_partkey, l_linenumber DESC) AS INTEGER) AS rank
        FROM lineitem""",
    "rank_one_day": """
        SELECT l_orderkey, l_linenumber, CAST(dense_rank() OVER (
            ORDER BY (l_orderkey * 7 + l_linenumber) % 86400 DESC) AS INTEGER) AS rank
        FROM lineitem""",
    "bridge_distinct": f"""{with_tables('onet_software_skills', 'onet_occupations')}
        SELECT DISTINCT s.onet_soc_code, s.soc_code, o.occupation_title,
          s.software_name, s.element_id, s.element_name, s.hot_technology, s.in_demand
        FROM onet_software_skills s
        LEFT JOIN onet_occupations o ON s.onet_soc_code = o.onet_soc_code
        WHERE s.software_name IS NOT NULL""",
    "bridge_label": f"""{with_tables('onet_job_zones', 'onet_occupations')}
        SELECT z.onet_soc_code, z.soc_code, o.occupation_title,
          o.description AS occupation_description, z.job_zone,
          CASE z.job_zone WHEN 1 THEN 'little_or_no_preparation'
            WHEN 2 THEN 'some_preparation' WHEN 3 THEN 'medium_preparation'
            WHEN 4 THEN 'high_preparation' WHEN 5 THEN 'extensive_preparation'
            ELSE 'unknown' END AS job_zone_label
        FROM onet_job_zones z
        LEFT JOIN onet_occupations o ON z.onet_soc_code = o.onet_soc_code""",
    "check_unique_key": """
        SELECT l_orderkey, l_linenumber, count(*) AS row_count FROM lineitem
        GROUP BY 1, 2 HAVING count(*) > 1""",
    "check_null_counts": f"""
        SELECT count(*) FILTER (WHERE raw_code IS NULL) AS null_codes,
          count(*) FILTER (WHERE raw_amount IS NULL) AS null_amounts,
          count(*) FILTER (WHERE raw_flag IS NULL) AS null_flags
        FROM ({CLEANED_ORDERS})""",
    "check_lookup_hits": f"""{STAR_FACT}
        SELECT count(*) AS total_oews_rows,
          count(occupation_name) AS rows_with_occupation_name,
          count(area_name) AS rows_with_area_name,
          count(industry_name) AS rows_with_industry_name,
          count(datatype_name) AS rows_with_datatype_name FROM fact""",
    "check_match_counts": f"""
        SELECT count(*) AS total_rows, count(c_custkey) AS matched_rows,
          count(*) - count(c_custkey) AS unmatched_rows
        FROM orders LEFT JOIN ({oracle_text(inputs.HOLED_LOOKUP)})
          ON o_custkey = c_custkey""",
    "unmatched_rows": f"""
        SELECT o_orderkey, o_custkey FROM orders WHERE o_custkey NOT IN (
          SELECT c_custkey FROM ({oracle_text(inputs.HOLED_LOOKUP)}))""",
    "check_coverage": """
        WITH c AS (SELECT c_nationkey AS k, count(DISTINCT c_custkey) AS n
                   FROM customer GROUP BY 1),
        s AS (SELECT s_nationkey AS k, count(DISTINCT s_suppkey) AS n
              FROM supplier GROUP BY 1),
        o AS (SELECT c_nationkey AS k, count(DISTINCT o_orderkey) AS n
              FROM orders JOIN customer ON o_custkey=c_custkey GROUP BY 1),
        p AS (SELECT s_nationkey AS k, count(DISTINCT l_partkey) AS n
              FROM lineitem JOIN supplier ON l_suppkey=s_suppkey GROUP BY 1)
        SELECT n_nationkey, n_name, coalesce(c.n,0) AS customers,
          coalesce(s.n,0) AS suppliers, coalesce(o.n,0) AS orders,
          coalesce(p.n,0) AS parts
        FROM nation LEFT JOIN c ON c.k=n_nationkey LEFT JOIN s ON s.k=n_nationkey
        LEFT JOIN o ON o.k=n_nationkey LEFT JOIN p ON p.k=n_nationkey
        ORDER BY n_nationkey""",
    "bridge_coverage": f"""WITH dim AS ({OCCUPATION_DIMENSION}),
        e AS (SELECT {inputs.code('o_custkey')} AS k, o_custkey AS m FROM orders),
        s AS (SELECT {inputs.code('o_custkey')} AS k, o_custkey AS m
              FROM lineitem JOIN orders ON l_orderkey=o_orderkey WHERE l_partkey%50<>0),
        w AS (SELECT {inputs.code('o_custkey')} AS k, o_custkey AS m
              FROM lineitem JOIN orders ON l_orderkey=o_orderkey WHERE l_partkey%40<>0),
        z AS (SELECT {inputs.code('c_custkey')} AS k, c_custkey AS m FROM customer),
        ec AS (SELECT k, count(DISTINCT m) AS n FROM e GROUP BY k),
        sc AS (SELECT k, count(DISTINCT m) AS n FROM s GROUP BY k),
        wc AS (SELECT k, count(DISTINCT m) AS n FROM w GROUP BY k),
        zc AS (SELECT k, count(DISTINCT m) AS n FROM z GROUP BY k)
        SELECT soc_code, occupation_title,
          coalesce(ec.n,0) AS onet_occupations_with_education,
          coalesce(sc.n,0) AS onet_occupations_with_skills,
          coalesce(wc.n,0) AS onet_occupations_with_software,
          coalesce(zc.n,0) AS onet_occupations_with_job_zone
        FROM dim LEFT JOIN ec ON ec.k=soc_code LEFT JOIN sc ON sc.k=soc_code
        LEFT JOIN wc ON wc.k=soc_code LEFT JOIN zc ON zc.k=soc_code""",
    "metric_counters": f"""{PROJECTION_FACT}
        SELECT CAST(sum(employment_base_year) AS BIGINT) AS total_base_employment,
          CAST(sum(employment_projected_year) AS BIGINT) AS total_projected_employment,
          CAST(sum(annual_openings) AS BIGINT) AS total_annual_openings,
          round(avg(median_annual_wage),4) AS avg_median_wage FROM board""",
    "metric_by_dimension": """
        SELECT o_orderpriority AS priority, count(*) AS n_orders,
          CAST(sum(CAST(round(o_totalprice*100) AS BIGINT)) AS BIGINT) AS total_cents,
          round(sum(CAST(round(o_totalprice*100) AS BIGINT))/count(*),2) AS mean_cents
        FROM orders WHERE o_orderstatus='F' AND o_orderpriority<>'5-LOW'
          AND year(o_orderdate) IN (1996,1997,1998) GROUP BY 1""",
    "top_growth": f"""{PROJECTION_FACT}
        SELECT employment_change_percent, occupation_title FROM board
        ORDER BY 1 DESC NULLS LAST, 2 LIMIT 15""",
    "top_measure_groups": f"""{PROJECTION_FACT}
        SELECT occupation_title, CAST(sum(annual_openings) AS BIGINT)
          AS total_annual_openings
        FROM board GROUP BY 1 ORDER BY 2 DESC NULLS LAST, 1 LIMIT 15""",
    "top_paying": f"""{PROJECTION_FACT}
        SELECT median_annual_wage, occupation_title FROM board
        ORDER BY 1 DESC NULLS LAST, 2 LIMIT 15""",
    "top_customers": """
        SELECT c_name AS name, c_custkey AS key, c_acctbal AS balance FROM customer
        ORDER BY c_acctbal DESC, c_name, c_custkey LIMIT 20""",
    "scatter_rows": f"""{PROJECTION_FACT}
        SELECT median_annual_wage, employment_change_percent FROM board""",
    "details_table": f"""{PROJECTION_FACT}
        SELECT occupation_title, typical_entry_education, median_annual_wage,
          employment_change_percent, annual_openings, on_the_job_training
        FROM board WHERE typical_entry_education IS NOT NULL""",
    "facet_counts": f"{PROJECTION_FACT} "
    + " UNION ALL ".join(
        [
            facet("occupation_title", f"{_GROWTH} AND {_EDUCATION}"),
            facet("occupation_type", f"{_GROWTH} AND {_EDUCATION}"),
            facet("typical_entry_education", _GROWTH),
            facet("growth_direction", _EDUCATION),
            facet("on_the_job_training", f"{_GROWTH} AND {_EDUCATION}"),
        ]
    ),
    "order_metrics": f"""{KEPT_ORDERS}
        SELECT code, CAST(sum(amount) AS BIGINT) AS total_amount FROM k
        WHERE rn=1 AND amount_qualifier <> 'less_than'
        GROUP BY code ORDER BY 2 DESC NULLS LAST, 1 LIMIT 15""",
}
ORACLES["dedup_by_places"] = ORACLES["dedup_keep_min_hash"]
ORACLES |= {
    published: ORACLES[frame]
    for published, frame in {
        "published_dimension": "occupation_dimension",
        "published_star_fact": "star_fact",
        "published_education": "bridge_distribution",
        "published_skill": "bridge_family_rank",
        "published_software": "bridge_distinct",
        "published_job_zone": "bridge_label",
    }.items()
}
_CODED = """SELECT DISTINCT code AS onet_soc_code_raw, code AS onet_soc_code,
          substr(code,1,7) AS soc_code,"""
ORACLES |= {
    "job_lookup_all_columns": f"""
        SELECT DISTINCT industry_code, trim(industry_name) AS industry_name,
          TRY_CAST(display_level AS INT) AS display_level, selectable,
          CAST(sort_sequence AS INT) AS sort_sequence
        FROM ({oracle_text(INDUSTRY_SOURCE)}) WHERE trim(industry_name)<>''""",
    "job_header_offset": f"""
        SELECT DISTINCT code AS soc_code_raw, title AS occupation_title,
          CAST(sort_order AS INT) AS sort_order, occupation_type,
          TRY_CAST(level AS INT) AS occupation_level, code AS soc_code
        FROM ({oracle_text(MATRIX_COVERAGE_SOURCE)}) WHERE code<>'none' AND title<>''""",
    "job_category_rating": f"""
        {_CODED} element_id, element_name, scale_id, CAST(category AS INT) AS category,
          CAST(data_value AS DOUBLE) AS data_value, TRY_CAST(n_asked AS INT) AS n,
          TRY_CAST(standard_error AS DOUBLE) AS standard_error,
          CAST(lower_ci_bound AS DOUBLE) AS lower_ci_bound,
          TRY_CAST(upper_ci_bound AS DOUBLE) AS upper_ci_bound,
          CASE recommend_suppress WHEN 'Y' THEN true WHEN 'N' THEN false
            WHEN ' no ' THEN false END AS recommend_suppress,
          date AS source_date_raw, {month('date')} AS data_month, domain_source
        FROM ({oracle_text(EDUCATION_SOURCE)})
        WHERE code<>'none' AND category<>'top' AND data_value<>'high'""",
    "job_software_flags": f"""
        {_CODED} example AS software_name, element_id, element_name,
          CASE hot WHEN 'Y' THEN true WHEN 'N' THEN false END AS hot_technology,
          in_demand='true' AS in_demand
        FROM ({oracle_text(SOFTWARE_SOURCE)}) WHERE code<>'11-10' AND example<>'N/A'""",
    "job_task_statements": f"""
        {_CODED} CAST(task_id AS BIGINT) AS task_id, task AS task_statement,
          nullif(task_type,'-') AS task_type,
          CASE WHEN asked<>'1.5' THEN CAST(asked AS INT) END AS incumbents_responding,
          date AS source_date_raw, {month('date')} AS data_month, domain_source
        FROM ({oracle_text(TASK_SOURCE)}) WHERE task_id<>'first'""",
    "job_code_pairs": f"""
        {_CODED} related AS related_onet_soc_code_raw, tier AS relatedness_tier,
          TRY_CAST(place AS INT) AS "index", related AS related_onet_soc_code,
          substr(related,1,7) AS related_soc_code
        FROM ({oracle_text(RELATED_SOURCE)}) WHERE related<>'none'""",
}
