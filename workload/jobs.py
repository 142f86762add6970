"""Queries that run the table job: sources written from the base tables, then the job.

Every source has exact copies, rows without a required value, values of a wrong form and
values that do not cast. The catalog database of a run is dropped at its end; the results
are read from the folders of its tables.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.operators.clean import with_lineage
from strata.plans import gold_views, occupation_tables, survey_tables
from strata.plans.spec import TableSpec
from strata.plans.table_job import AUDIT_TABLE, ISSUE_TABLE, TableJob
from strata.sources.tables import new_folder, stage, write_table
from workload.inputs import CLEAN_TABLES, code, derive

# Texts that both engines read; ``line`` makes the fields of a source strings.
OBSERVATION_SOURCE = """
WITH b AS (SELECT l_orderkey AS k, l_linenumber AS n, CAST(max(l_quantity) AS INT) AS q
           FROM {lineitem} GROUP BY l_orderkey, l_linenumber),
r AS (SELECT CASE WHEN k%50=1 THEN 'N/A' ELSE CAST(k AS STRING) END AS series_id,
        CAST(2000+n AS STRING) AS year,
        CASE WHEN k%9=0 THEN 'late' ELSE concat('M0',CAST(n AS STRING)) END AS period,
        CASE WHEN k%7=0 THEN 'abc' ELSE CAST(q AS STRING) END AS value,
        CASE WHEN k%3=0 THEN '-' ELSE '1' END AS footnote_codes, k FROM b)
SELECT series_id, year, period, value, footnote_codes FROM r
UNION ALL
SELECT series_id, year, period, value, footnote_codes FROM r WHERE k%10=0
"""

ZONE_SOURCE = f"""
WITH r AS (SELECT CASE WHEN c_custkey%50=1 THEN 'none'
               ELSE concat({code('c_custkey')},'.00') END AS code,
             CASE WHEN c_custkey%13=0 THEN '2.5'
               ELSE CAST(c_custkey%8 AS STRING) END AS job_zone,
             CASE WHEN c_custkey%11=0 THEN '13/2024' ELSE '07/2023' END AS date,
             'Analyst' AS domain_source, c_custkey AS k FROM {{customer}})
SELECT code, job_zone, date, domain_source FROM r
UNION ALL
SELECT code, job_zone, date, domain_source FROM r WHERE k%10=0
"""

INDUSTRY_SOURCE = """
WITH r AS (SELECT concat('I',CAST(s_suppkey AS STRING)) AS industry_code,
        CASE WHEN s_suppkey%10=3 THEN ' ' ELSE concat(' ',s_name) END AS industry_name,
        CASE WHEN s_suppkey%7=0 THEN 'top' ELSE CAST(s_nationkey AS STRING) END AS display_level,
        CASE WHEN s_suppkey%2=0 THEN 'T' ELSE 'F' END AS selectable,
        CAST(s_suppkey AS STRING) AS sort_sequence, s_suppkey AS k FROM {supplier})
SELECT industry_code, industry_name, display_level, selectable, sort_sequence FROM r
UNION ALL
SELECT industry_code, industry_name, display_level, selectable, sort_sequence
FROM r WHERE k%10=0
"""

EDUCATION_SOURCE = f"""
WITH b AS (SELECT l_orderkey AS k, l_linenumber AS n, CAST(max(l_quantity) AS INT) AS q
           FROM {{lineitem}} GROUP BY l_orderkey, l_linenumber),
r AS (SELECT CASE WHEN k%50=1 THEN 'none' ELSE concat({code('k')},'.0',CAST(n AS STRING)) END
          AS code,
        '2.D.1' AS element_id, 'Required Level' AS element_name, 'RL' AS scale_id,
        CASE WHEN k%11=0 THEN 'top' ELSE CAST(q%12+1 AS STRING) END AS category,
        CASE WHEN k%7=0 THEN 'high' ELSE concat(CAST(q AS STRING),'.5') END AS data_value,
        CASE WHEN k%13=0 THEN 'few' ELSE CAST(q AS STRING) END AS n_asked,
        CASE WHEN k%2=0 THEN '0.25' ELSE 'N/A' END AS standard_error,
        '1.5' AS lower_ci_bound, CASE WHEN k%3=0 THEN '-' ELSE '99' END AS upper_ci_bound,
        CASE k%4 WHEN 0 THEN 'Y' WHEN 1 THEN ' no ' WHEN 2 THEN 'maybe' ELSE 'N' END
          AS recommend_suppress,
        CASE WHEN k%17=0 THEN '2023-07' ELSE '07/2023' END AS date,
        'Incumbent' AS domain_source, k FROM b)
SELECT code, element_id, element_name, scale_id, category, data_value, n_asked,
  standard_error, lower_ci_bound, upper_ci_bound, recommend_suppress, date, domain_source
FROM r
UNION ALL
SELECT code, element_id, element_name, scale_id, category, data_value, n_asked,
  standard_error, lower_ci_bound, upper_ci_bound, recommend_suppress, date, domain_source
FROM r WHERE k%10=0
"""

SOFTWARE_SOURCE = f"""
WITH r AS (SELECT CASE WHEN o_orderkey%50=1 THEN '11-10' ELSE concat({code('o_custkey')},'.00')
             END AS code,
        CASE WHEN o_orderkey%29=0 THEN 'N/A' ELSE concat('tool ',CAST(o_orderkey AS STRING))
             END AS example,
        concat('4.',CAST(o_custkey%9 AS STRING)) AS element_id, 'Tools' AS element_name,
        CASE WHEN o_orderstatus='O' THEN 'Y' WHEN o_orderstatus='F' THEN 'N' ELSE '?' END AS hot,
        CASE WHEN o_orderkey%3=0 THEN 'true' ELSE '0' END AS in_demand, o_orderkey AS k
      FROM {{orders}})
SELECT code, example, element_id, element_name, hot, in_demand FROM r
UNION ALL
SELECT code, example, element_id, element_name, hot, in_demand FROM r WHERE k%10=0
"""

TASK_SOURCE = f"""
WITH r AS (SELECT concat({code('p_partkey')},'.00') AS code,
        CASE WHEN p_partkey%13=0 THEN 'first' ELSE CAST(p_partkey AS STRING) END AS task_id,
        p_name AS task, CASE WHEN p_size<25 THEN 'Core' ELSE '-' END AS task_type,
        CASE WHEN p_partkey%5=0 THEN '1.5' ELSE CAST(p_size AS STRING) END AS asked,
        '13/2024' AS date, 'Analyst' AS domain_source, p_partkey AS k FROM {{part}})
SELECT code, task_id, task, task_type, asked, date, domain_source FROM r
UNION ALL
SELECT code, task_id, task, task_type, asked, date, domain_source FROM r WHERE k%10=0
"""

RELATED_SOURCE = f"""
WITH r AS (SELECT concat({code('o_custkey')},'.00') AS code,
        CASE WHEN o_orderkey%50=1 THEN 'none' ELSE concat({code('o_orderkey')},'.01') END
          AS related, 'Primary' AS tier,
        CASE WHEN o_orderkey%9=0 THEN 'last' ELSE CAST(o_orderkey%20 AS STRING) END AS place,
        o_orderkey AS k FROM {{orders}})
SELECT code, related, tier, place FROM r
UNION ALL
SELECT code, related, tier, place FROM r WHERE k%10=0
"""

MATRIX_COVERAGE_SOURCE = f"""
WITH r AS (SELECT CASE WHEN c_custkey%50=1 THEN 'none' ELSE {code('c_custkey')} END AS code,
        CASE WHEN c_custkey%8=0 THEN '' ELSE c_name END AS title,
        CAST(c_custkey AS STRING) AS sort_order, c_mktsegment AS occupation_type,
        CASE WHEN c_custkey%6=0 THEN 'low' ELSE CAST(c_nationkey AS STRING) END AS level,
        c_custkey AS k FROM {{customer}})
SELECT code, title, sort_order, occupation_type, level FROM r
UNION ALL
SELECT code, title, sort_order, occupation_type, level FROM r WHERE k%10=0
"""

_RATED = {
    "code": "O*NET-SOC Code", "element_id": "Element ID", "element_name": "Element Name",
    "scale_id": "Scale ID", "category": "Category", "data_value": "Data Value",
    "n_asked": "N", "standard_error": "Standard Error", "lower_ci_bound": "Lower CI Bound",
    "upper_ci_bound": "Upper CI Bound", "recommend_suppress": "Recommend Suppress",
    "date": "Date", "domain_source": "Domain Source",
}

SOURCES = {
    "bls_oews_industries": (survey_tables.INDUSTRIES, INDUSTRY_SOURCE, {}),
    "bls_nem_occupational_coverage": (
        survey_tables.COVERAGE,
        MATRIX_COVERAGE_SOURCE,
        {"code": "NEM code", "title": "NEM title", "sort_order": "Sort order",
         "occupation_type": "Occupation type", "level": "Level"},
    ),
    "onet_education": (occupation_tables.EDUCATION, EDUCATION_SOURCE, _RATED),
    "onet_software_skills": (
        occupation_tables.SOFTWARE_SKILLS,
        SOFTWARE_SOURCE,
        {"code": "O*NET-SOC Code", "example": "Workplace Example",
         "element_id": "Element ID", "element_name": "Element Name",
         "hot": "Hot Technology", "in_demand": "In Demand"},
    ),
    "onet_task_statements": (
        occupation_tables.TASK_STATEMENTS,
        TASK_SOURCE,
        {"code": "O*NET-SOC Code", "task_id": "Task ID", "task": "Task",
         "task_type": "Task Type", "asked": "Incumbents Responding", "date": "Date",
         "domain_source": "Domain Source"},
    ),
    "onet_related_occupations": (
        occupation_tables.RELATED_OCCUPATIONS,
        RELATED_SOURCE,
        {"code": "O*NET-SOC Code", "related": "Related O*NET-SOC Code",
         "tier": "Relatedness Tier", "place": "Index"},
    ),
    "bls_oews_observations": (survey_tables.OBSERVATIONS, OBSERVATION_SOURCE, {}),
    "onet_job_zones": (
        occupation_tables.JOB_ZONES,
        ZONE_SOURCE,
        {"code": "O*NET-SOC Code", "job_zone": "Job Zone", "date": "Date",
         "domain_source": "Domain Source"},
    ),
}


def _source(spark: SparkSession, d: str, name: str, folder: str) -> tuple[TableSpec, str]:
    """Write the source of a table as its spec expects to find it."""
    spec, text, headers = SOURCES[name]
    path = f"{folder}/source-{name}"
    rows = derive(spark, d, text).withColumnsRenamed(headers)
    if spec.header_row is None:
        rows.write.csv(path, sep="\t", header=True)
    else:
        _write_sheets(rows, path, spec.header_row)
    return spec, path


def _write_sheets(rows: DataFrame, path: str, header_row: int) -> None:
    """Write rows to a few files that each have lines of junk above the header."""
    files = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    line = F.concat_ws("\t", *[F.col(f"`{c}`") for c in rows.columns])
    junk = [f"Table 1.{i}" for i in range(header_row)]
    top = "\n".join([*junk, "\t".join(rows.columns)])
    tops = rows.sparkSession.range(files).select(
        F.col("id").cast("int").alias("part"), F.lit(0).alias("place"),
        F.lit(top).alias("value"),
    )
    body = rows.select(
        F.pmod(F.xxhash64(line), F.lit(files)).cast("int").alias("part"),
        F.lit(1).alias("place"), line.alias("value"),
    )
    (
        tops.unionAll(body)
        .repartition(files, "part")
        .sortWithinPartitions("part", "place")
        .select("part", "value")
        .write.partitionBy("part")
        .text(path)
    )


class _Run:
    """One run of the job in a database of its own."""

    def __init__(self, spark: SparkSession, d: str, names: list[str]):
        self.spark = spark
        self.folder = new_folder(spark, "job-query")
        self.schema = f"job_{uuid.uuid4().hex}"
        made = [_source(spark, d, n, self.folder) for n in names]
        self.specs = [spec for spec, _ in made]
        self.paths = {spec.name: path for spec, path in made}

    def run(self, read: list[str], times: int = 1) -> dict[str, DataFrame]:
        """Run the job; frames over the files of the tables to be read."""

        def work(job: TableJob) -> None:
            try:
                for _ in range(times):
                    job.run(self.specs, self.paths, run_id="run-1")
            except RuntimeError:
                if AUDIT_TABLE not in read or len(read) > 1:
                    raise

        return self.within(work, read)

    def within(self, work: Callable[[TableJob], None], read: list[str], **job) -> dict:
        """Let ``work`` use the job; frames over the files of the tables to be read."""
        spark = self.spark
        spark.sql(f"CREATE DATABASE {self.schema} LOCATION '{self.folder}/database'")
        try:
            work(TableJob(spark, self.schema, f"{self.folder}/tables", **job))
            return {name: self._files(name) for name in read}
        finally:
            spark.sql(f"DROP DATABASE {self.schema} CASCADE")

    def _files(self, name: str) -> DataFrame:
        table = self.spark.table(f"{self.schema}.{name}")
        described = self.spark.sql(f"DESCRIBE TABLE EXTENDED {self.schema}.{name}")
        place = described.filter("col_name = 'Location'").first()["data_type"]
        return self.spark.read.schema(table.schema).parquet(place)


def job_observations(spark: SparkSession, d: str) -> DataFrame:
    """Clean observations as the job writes them."""
    name = "bls_oews_observations"
    clean = _Run(spark, d, [name]).run([name])[name]
    return clean.drop("source_file_path", "run_id", "processed_at")


def job_zones(spark: SparkSession, d: str) -> DataFrame:
    """Clean job zones, whose range is checked and whose codes are split."""
    name = "onet_job_zones"
    clean = _Run(spark, d, [name]).run([name])[name]
    return clean.drop("source_file_path", "run_id", "processed_at")


def _clean_rows(name: str) -> Callable[[SparkSession, str], DataFrame]:
    def query(spark: SparkSession, d: str) -> DataFrame:
        clean = _Run(spark, d, [name]).run([name])[name]
        return clean.drop("source_file_path", "run_id", "processed_at")

    return query


#: Clean rows of one table for each shape of declaration.
TABLE_ROWS = {
    "job_lookup_all_columns": "bls_oews_industries",
    "job_header_offset": "bls_nem_occupational_coverage",
    "job_category_rating": "onet_education",
    "job_software_flags": "onet_software_skills",
    "job_task_statements": "onet_task_statements",
    "job_code_pairs": "onet_related_occupations",
}


def job_log(spark: SparkSession, d: str, times: int = 1) -> DataFrame:
    """Issues by rule and the audit rows of a run over two source systems."""
    read = _Run(spark, d, ["bls_oews_observations", "onet_job_zones"]).run(
        [ISSUE_TABLE, AUDIT_TABLE], times
    )
    issues = read[ISSUE_TABLE].groupBy(
        F.col("dataset_name").alias("table_name"), F.col("rule_name").alias("entry")
    ).agg(F.count(F.lit(1)).alias("n_rows"))
    audit = read[AUDIT_TABLE].select(
        "table_name", F.concat_ws(" ", "status", "write_mode").alias("entry"), "row_count"
    )
    short = F.element_at(F.split("table_name", r"\."), -1).alias("table_name")
    return issues.unionAll(audit).select(short, "entry", "n_rows")


def job_log_repeated(spark: SparkSession, d: str) -> DataFrame:
    """The same after the run was repeated under its id."""
    return job_log(spark, d, times=2)


def job_all_or_none(spark: SparkSession, d: str) -> DataFrame:
    """Tables and audit after a run, and one that fails between its tables.

    The second run reads sources without rows; the tables still hold the first one's.
    """
    names = ["bls_oews_observations", "onet_job_zones"]
    run = _Run(spark, d, names)
    empty = {}
    for name in names:
        empty[name] = f"{run.folder}/empty-{name}"
        source = spark.read.csv(run.paths[name], sep="\t", header=True)
        source.limit(0).write.csv(empty[name], sep="\t", header=True)
    wrong = TableSpec(
        "no such database.t", "LATE", "f", required=("series_id",), key=("series_id",)
    )

    def work(job: TableJob) -> None:
        job.run(run.specs, run.paths, run_id="run-1")
        paths = empty | {wrong.name: empty[names[0]]}
        try:
            job.run([*run.specs, wrong], paths, run_id="run-2")
        except RuntimeError:
            return
        raise AssertionError("the second run should have failed")

    read = run.within(work, [*names, AUDIT_TABLE], together=True)
    last = F.element_at(F.split("table_name", r"\."), -1)
    audit = read[AUDIT_TABLE].select(
        last.alias("table_name"), F.concat_ws(" ", "run_id", "status").alias("entry"),
        F.col("row_count").alias("n_rows"),
    )
    held = [
        read[n].agg(F.count(F.lit(1)).alias("n_rows")).select(
            F.lit(n).alias("table_name"), F.lit("rows").alias("entry"), "n_rows"
        )
        for n in names
    ]
    return reduce(DataFrame.unionAll, held, audit)


def job_failure(spark: SparkSession, d: str) -> DataFrame:
    """Audit rows of a run whose second source system fails; its later table is absent."""
    run = _Run(spark, d, ["bls_oews_observations", "onet_job_zones"])
    broken = TableSpec(
        "no such database.t", "LATE", "f", required=("series_id",),
        key=("series_id", "year", "period"),
    )
    run.specs = [run.specs[0], broken, run.specs[1]]
    run.paths[broken.name] = run.paths["bls_oews_observations"]
    audit = run.run([AUDIT_TABLE])[AUDIT_TABLE]
    last = F.element_at(F.split("table_name", r"\."), -1)
    return audit.select(
        last.alias("table_name"),
        "status",
        "row_count",
        F.col("error_message").isNotNull().alias("has_error"),
    )


def published_view(spark: SparkSession, d: str) -> DataFrame:
    """A catalog view, read after its table was overwritten and then appended to."""
    name = "bls_employment_projections"
    schema = f"view_{uuid.uuid4().hex}"
    folder = new_folder(spark, schema)
    rows = with_lineage(derive(spark, d, CLEAN_TABLES[name]), name, "run-1")
    spark.sql(f"CREATE DATABASE {schema} LOCATION '{folder}/database'")
    try:
        path = f"{folder}/{name}"
        write_table(rows.limit(0), f"{schema}.{name}", path=path)
        gold_views.publish(spark, schema, schema, ["fact_occupation_projection"])
        write_table(rows, f"{schema}.{name}", path=path)
        write_table(rows, f"{schema}.{name}", "append", path=path)
        read = spark.table(f"{schema}.fact_occupation_projection")
        return stage(read.drop("source_file_path", "run_id", "processed_at"), schema)
    finally:
        spark.sql(f"DROP DATABASE {schema} CASCADE")


#: Query name: the view it reads and the clean tables that this view stands on.
VIEW_ROWS = {
    "published_dimension": (
        "dim_occupation",
        ("bls_employment_projections", "bls_oews_occupations", "onet_occupations"),
    ),
    "published_star_fact": (
        "fact_oews_measurement",
        ("bls_oews_observations", "bls_oews_series", "bls_oews_occupations",
         "bls_oews_areas", "bls_oews_industries", "bls_oews_datatypes"),
    ),
    "published_education": (
        "bridge_occupation_education",
        ("onet_education", "onet_education_categories", "onet_occupations"),
    ),
    "published_skill": (
        "bridge_occupation_skill",
        ("onet_essential_skills", "onet_transferable_skills", "onet_occupations"),
    ),
    "published_software": (
        "bridge_occupation_software", ("onet_software_skills", "onet_occupations"),
    ),
    "published_job_zone": (
        "bridge_occupation_job_zone", ("onet_job_zones", "onet_occupations"),
    ),
}


def _published(view: str, names: tuple[str, ...]) -> Callable[[SparkSession, str], DataFrame]:
    def query(spark: SparkSession, d: str) -> DataFrame:
        """A catalog view, read after all of its tables were written."""
        schema = f"view_{uuid.uuid4().hex}"
        folder = new_folder(spark, schema)
        spark.sql(f"CREATE DATABASE {schema} LOCATION '{folder}/database'")
        try:
            for name in names:
                rows = with_lineage(derive(spark, d, CLEAN_TABLES[name]), name, "run-1")
                write_table(rows, f"{schema}.{name}", path=f"{folder}/{name}")
            gold_views.publish(spark, schema, schema, [view])
            read = spark.table(f"{schema}.{view}")
            return stage(read.drop("source_file_path", "run_id", "processed_at"), schema)
        finally:
            spark.sql(f"DROP DATABASE {schema} CASCADE")

    return query


QUERIES = {
    f.__name__: f
    for f in (
        job_observations,
        job_zones,
        job_log,
        job_log_repeated,
        job_all_or_none,
        job_failure,
        published_view,
    )
}
QUERIES |= {name: _clean_rows(table) for name, table in TABLE_ROWS.items()}
QUERIES |= {name: _published(*what) for name, what in VIEW_ROWS.items()}
