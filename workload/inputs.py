"""Inputs derived from the test tables.

The test tables are clean, so the dirt is derived from their keys. Each text reads
the same in Spark SQL and in the checking engine; ``{table}`` marks a base table.
Every row of the base tables takes part.
"""

from __future__ import annotations

import string

from pyspark.sql import DataFrame, SparkSession

TABLES = (
    "region",
    "nation",
    "customer",
    "supplier",
    "part",
    "orders",
    "lineitem",
    "events",
    "documents",
    "embeddings",
    "pages",
    "benchmark",
    "labels",
    "conversations",
)


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def _names(text: str) -> set[str]:
    return {field for _, field, _, _ in string.Formatter().parse(text) if field}


def derive(spark: SparkSession, folder: str, text: str) -> DataFrame:
    """Run an input text on the base tables it names."""
    frames = {name: table(spark, folder, name) for name in _names(text)}
    return spark.sql(text, **frames)


def oracle_text(text: str) -> str:
    """The input text with plain table names."""
    return text.format(**{name: name for name in _names(text)})


def code(key: str) -> str:
    """A base code from an integer key."""
    digits = f"lpad(CAST({key} AS STRING),6,'0')"
    return f"concat(substr({digits},1,2),'-',substr({digits},3,4))"


DIRTY_ORDERS = """
WITH b AS (SELECT *, lpad(CAST(o_custkey AS STRING),6,'0') AS d6,
                  lpad(CAST(o_orderkey%5 AS STRING),2,'0') AS ext,
                  CAST(round(o_totalprice*100) AS BIGINT) AS cents FROM {orders})
SELECT o_orderkey,
  CASE o_orderkey%8
    WHEN 0 THEN d6
    WHEN 1 THEN concat(substr(d6,1,2),'-',substr(d6,3,4))
    WHEN 2 THEN concat(substr(d6,1,2),'-',substr(d6,3,4),'.00')
    WHEN 3 THEN concat('  ',substr(d6,1,2),'-',substr(d6,3,4),'.',ext,' ')
    WHEN 4 THEN concat(substr(d6,1,2),'-',substr(d6,3,2))
    WHEN 5 THEN '-' WHEN 6 THEN 'N/A'
    ELSE concat(substr(d6,1,2),'-',substr(d6,3,4),'.',ext) END AS raw_code,
  CASE o_orderkey%9
    WHEN 0 THEN concat('>=$',CAST(cents AS STRING))
    WHEN 1 THEN concat('$',CAST(CAST(floor(cents/1000) AS BIGINT) AS STRING),',',
                       lpad(CAST(cents%1000 AS STRING),3,'0'))
    WHEN 2 THEN concat('<',CAST(cents AS STRING))
    WHEN 3 THEN concat('<= ',CAST(cents AS STRING))
    WHEN 4 THEN concat('≥',CAST(cents AS STRING))
    WHEN 5 THEN 'abc' WHEN 6 THEN '—'
    WHEN 7 THEN concat(CAST(cents AS STRING),'%')
    ELSE concat(' ',CAST(cents AS STRING),' ') END AS raw_amount,
  CASE o_orderkey%7 WHEN 0 THEN 'Y' WHEN 1 THEN ' yes ' WHEN 2 THEN 'TRUE'
    WHEN 3 THEN '0' WHEN 4 THEN 'n' WHEN 5 THEN 'maybe' ELSE NULL END AS raw_flag,
  CASE WHEN o_orderkey%11=0 THEN '13/2024'
    ELSE concat(lpad(CAST(month(o_orderdate) AS STRING),2,'0'),'/',
                CAST(year(o_orderdate) AS STRING)) END AS raw_month,
  CASE WHEN o_orderkey%13=0 THEN '2.5' ELSE CAST(o_orderkey%8 AS STRING) END AS raw_zone
FROM b
"""

# Every tenth order once more, so that exact copies occur.
REPEATED_ORDERS = f"""
WITH dirty AS ({DIRTY_ORDERS})
SELECT * FROM dirty UNION ALL SELECT * FROM dirty WHERE o_orderkey%10=0
"""

DIRTY_LINEITEM = """
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
       CAST(round(l_extendedprice*100) AS BIGINT) AS cents, l_returnflag
FROM {lineitem}
UNION ALL
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
       CAST(round(l_extendedprice*100) AS BIGINT) AS cents, l_returnflag
FROM {lineitem} WHERE l_orderkey%10=0
"""

PERIODS = """
SELECT o_orderkey, CAST(year(o_orderdate) AS INT) AS yr,
  CASE o_orderkey%6 WHEN 0 THEN 'A01' WHEN 1 THEN 'M13'
    WHEN 2 THEN concat('M',lpad(CAST(month(o_orderdate) AS STRING),2,'0'))
    WHEN 3 THEN 'S01' WHEN 4 THEN 'S02' ELSE 'Q01' END AS period
FROM {orders}
"""

_PLACE = (
    "concat('1',CAST(n_regionkey AS STRING),'-',"
    "lpad(CAST(n_nationkey+1 AS STRING),4,'0'))"
)
# Three sources of coded titles; regions are the major groups of their nations.
# A title or a code is missing here and there.
PLACES = {
    "nation": f"""
        SELECT concat('1',CAST(r_regionkey AS STRING),'-0000') AS soc_code,
               r_name AS title, CAST(r_regionkey AS BIGINT) AS member FROM {{region}}
        UNION ALL
        SELECT {_PLACE}, CASE WHEN n_nationkey%5=1 THEN NULL ELSE n_name END,
               CAST(n_nationkey AS BIGINT) FROM {{nation}}
    """,
    "customer": f"""
        SELECT CASE WHEN n_nationkey%3=0 THEN 'none' ELSE {_PLACE} END AS soc_code,
               c_name AS title, c_custkey AS member
        FROM {{customer}} JOIN {{nation}} ON c_nationkey=n_nationkey
    """,
    "supplier": f"""
        SELECT CASE WHEN s_suppkey%9=0 OR n_nationkey%4=0 THEN 'none'
                    ELSE {_PLACE} END AS soc_code,
               s_name AS title, s_suppkey AS member
        FROM {{supplier}} JOIN {{nation}} ON s_nationkey=n_nationkey
    """,
}

# Clean tables of the survey, in their own layout.
OBSERVATIONS = """
SELECT CAST(l_orderkey AS STRING) AS series_id, CAST(year(l_shipdate) AS INT) AS year,
  CASE l_linenumber%6 WHEN 0 THEN 'A01' WHEN 1 THEN 'M13'
    WHEN 2 THEN concat('M',lpad(CAST(month(l_shipdate) AS STRING),2,'0'))
    WHEN 3 THEN 'S01' WHEN 4 THEN 'S02' ELSE 'Q01' END AS period,
  CASE WHEN l_linenumber=7 THEN NULL ELSE l_quantity END AS value,
  CAST(CAST(l_quantity AS INT) AS STRING) AS value_raw, l_returnflag AS footnote_codes
FROM {lineitem}
"""
SERIES = f"""
SELECT CASE WHEN o_orderkey%19=0 THEN 'no series' ELSE CAST(o_orderkey AS STRING) END
    AS series_id, o_orderstatus AS seasonal,
  o_orderpriority AS series_title, CAST(o_custkey AS STRING) AS area_code,
  CAST(o_orderkey%25 AS STRING) AS industry_code,
  CAST(o_orderkey%2000 AS STRING) AS occupation_code,
  CASE WHEN o_orderkey%3=0 THEN NULL ELSE {code('o_custkey')} END AS soc_code,
  CAST(o_orderkey%7 AS STRING) AS datatype_code
FROM {{orders}}
"""
SURVEY_OCCUPATIONS = f"""
SELECT CAST(p_partkey AS STRING) AS occupation_code, {code('p_partkey')} AS soc_code,
       p_name AS occupation_name FROM {{part}}
"""
# Two records per area; every tenth area has a code that no series has.
_AREA = "concat(CASE WHEN c_custkey%10=0 THEN 'x' ELSE '' END,CAST(c_custkey AS STRING))"
AREAS = f"""
SELECT {_AREA} AS area_code, c_name AS area_name FROM {{customer}}
UNION ALL
SELECT {_AREA}, c_mktsegment FROM {{customer}}
"""
INDUSTRIES = """
SELECT CAST(n_nationkey AS STRING) AS industry_code, n_name AS industry_name FROM {nation}
"""
DATATYPES = """
SELECT CAST(r_regionkey AS STRING) AS datatype_code, r_name AS datatype_name FROM {region}
"""
PROJECTIONS = f"""
SELECT CASE WHEN p_partkey%10=0 THEN CAST(p_partkey AS STRING)
            ELSE {code('p_partkey')} END AS soc_code,
  p_name AS occupation_title,
  CASE WHEN p_partkey%4=0 THEN 'Summary' ELSE 'Line item' END AS occupation_type,
  p_retailprice AS employment_base_year_thousands,
  p_retailprice+p_size AS employment_projected_year_thousands,
  CAST(p_size AS DOUBLE) AS employment_change_thousands,
  CAST(p_size%7 AS DOUBLE) AS annual_openings_thousands,
  CASE WHEN p_partkey%11=0 THEN NULL
       ELSE CAST(p_size-25 AS DOUBLE)/2 END AS employment_change_percent,
  CAST(p_size AS DOUBLE) AS employment_distribution_base_percent,
  CAST(p_size AS DOUBLE) AS employment_distribution_projected_percent,
  CAST(p_size%5 AS DOUBLE) AS percent_self_employed,
  CASE WHEN p_partkey%17=0 THEN NULL
       ELSE CAST(p_size*1000 AS DOUBLE) END AS median_annual_wage,
  CAST(p_size*1000 AS STRING) AS median_annual_wage_raw,
  'exact' AS median_annual_wage_qualifier,
  CASE WHEN p_partkey%9=0 THEN NULL ELSE p_brand END AS typical_entry_education,
  p_type AS related_work_experience,
  CASE WHEN p_partkey%13=0 THEN NULL ELSE p_type END AS on_the_job_training
FROM {{part}}
"""

# Clean tables of the occupation content, in their own layout.
EDUCATION = f"""
SELECT concat({code('o_custkey')},'.00') AS onet_soc_code,
  {code('o_custkey')} AS soc_code, '2.D.1' AS element_id, 'Level' AS element_name,
  'RL' AS scale_id, CAST(substr(o_orderpriority,1,1) AS INT) AS category,
  CAST(count(*) AS DOUBLE) AS data_value
FROM {{orders}} GROUP BY o_custkey, substr(o_orderpriority,1,1)
"""
EDUCATION_CATEGORIES = """
SELECT DISTINCT '2.D.1' AS element_id, 'RL' AS scale_id,
  CASE WHEN substr(o_orderpriority,1,1)='3' THEN -3
       ELSE CAST(substr(o_orderpriority,1,1) AS INT) END AS category,
  o_orderpriority AS category_description
FROM {orders}
"""
# Every tenth customer has a code that no other table has.
OCCUPATIONS = f"""
SELECT concat({code('c_custkey')},CASE WHEN c_custkey%10=0 THEN '.99' ELSE '.00' END)
    AS onet_soc_code,
  CASE WHEN c_custkey%10=0 THEN 'none' ELSE {code('c_custkey')} END AS soc_code,
  c_name AS occupation_title, c_mktsegment AS description
FROM {{customer}}
"""


def _skills(condition: str) -> str:
    return f"""
    SELECT concat({code('o_custkey')},'.00') AS onet_soc_code,
      {code('o_custkey')} AS soc_code, CAST(l_partkey AS STRING) AS element_id,
      concat('skill ',CAST(l_partkey%100 AS STRING)) AS element_name,
      CASE l_linenumber%3 WHEN 0 THEN 'IM' WHEN 1 THEN 'lv' ELSE 'XX' END AS scale_id,
      CASE WHEN l_partkey%50=0 THEN NULL ELSE l_quantity END AS data_value
    FROM {{lineitem}} JOIN {{orders}} ON l_orderkey=o_orderkey WHERE {condition}
    """


ESSENTIAL_SKILLS = _skills("l_returnflag<>'R'")
TRANSFERABLE_SKILLS = _skills("l_returnflag='R'")
SOFTWARE = f"""
SELECT concat({code('o_custkey')},'.00') AS onet_soc_code,
  {code('o_custkey')} AS soc_code,
  CASE WHEN l_partkey%40=0 THEN NULL
       ELSE concat('tool ',CAST(l_partkey%300 AS STRING)) END AS software_name,
  CAST(l_linenumber AS STRING) AS element_id, 'Tools' AS element_name,
  l_returnflag='R' AS hot_technology, l_linestatus='O' AS in_demand
FROM {{lineitem}} JOIN {{orders}} ON l_orderkey=o_orderkey
"""
JOB_ZONES = f"""
SELECT concat({code('c_custkey')},'.00') AS onet_soc_code,
  {code('c_custkey')} AS soc_code, CAST(c_custkey%7 AS INT) AS job_zone
FROM {{customer}}
"""

# Every tenth customer has a key that no order has.
HOLED_LOOKUP = """
SELECT CASE WHEN c_custkey%10=0 THEN -c_custkey ELSE c_custkey END AS c_custkey,
       c_name, c_nationkey FROM {customer}
"""

CLEAN_TABLES = {
    "bls_oews_observations": OBSERVATIONS,
    "bls_oews_series": SERIES,
    "bls_oews_occupations": SURVEY_OCCUPATIONS,
    "bls_oews_areas": AREAS,
    "bls_oews_industries": INDUSTRIES,
    "bls_oews_datatypes": DATATYPES,
    "bls_employment_projections": PROJECTIONS,
    "onet_occupations": OCCUPATIONS,
    "onet_education": EDUCATION,
    "onet_education_categories": EDUCATION_CATEGORIES,
    "onet_essential_skills": ESSENTIAL_SKILLS,
    "onet_transferable_skills": TRANSFERABLE_SKILLS,
    "onet_software_skills": SOFTWARE,
    "onet_job_zones": JOB_ZONES,
}
