"""One query per operator, over the whole test tables."""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.functions.amounts import (
    amount_qualifier,
    amount_text,
    direction,
    safe_cast,
    thousands_to_count,
)
from strata.functions.codes import (
    BASE_CODE_PATTERN,
    base_code,
    detailed_code,
    preparation_label,
    scale_label,
    yes_no,
)
from strata.functions.keys import record_key, row_hash
from strata.functions.periods import observation_date, period_type, source_month
from strata.operators import checks
from strata.operators.clean import (
    Field,
    add_codes,
    base_frame,
    keep_required,
    normalize_headers,
    nullify_placeholders,
    select_existing,
    select_fields,
    select_mapped,
    split_detailed_code,
    trim_strings,
    with_lineage,
)
from strata.operators.dedup import (
    choose_rows,
    chosen_rows,
    deduplicate,
    duplicate_issues,
    placed,
)
from strata.operators.metrics import MetricView
from strata.operators.quality import (
    Dataset,
    InRange,
    Matches,
    Required,
    annotate,
    check,
    empty_issues,
    issue_rows,
    missing_column_rows,
    union_issues,
)
from strata.operators.ranking import dense_rank
from strata.plans import board, gold
from strata.plans.spec import Finished, TableSpec
from strata.plans.table_job import Audit, newest_first
from strata.sources.files import read_delimited, read_with_header_offset
from strata.sources.manifest import (
    ExpectedFile,
    missing_required,
    scanned_files,
    scanned_manifest,
)
from strata.sources.series import flatten_responses, latest
from strata.sources.tables import count_rows, new_folder, stage, write_table
from workload import inputs, jobs
from workload.inputs import derive, table

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = dict(jobs.QUERIES)

RUN_ID = "run-1"
RUN_TIME = dt.datetime(2024, 1, 1, tzinfo=dt.timezone.utc)
ISSUE_COLUMNS = (
    "run_id",
    "source_system",
    "dataset_name",
    "source_file_path",
    "record_key",
    "severity",
    "rule_name",
    "issue_message",
    "raw_value",
)


def query(run: Query) -> Query:
    QUERIES[run.__name__.removesuffix("_query")] = run
    return run


def _dirty_orders(spark: SparkSession, d: str) -> DataFrame:
    return derive(spark, d, inputs.DIRTY_ORDERS)


def _clean_strings(df: DataFrame) -> DataFrame:
    return df.transform(trim_strings).transform(nullify_placeholders)


def _clean_tables(spark: SparkSession, d: str, *names: str) -> dict[str, DataFrame]:
    return {
        n: with_lineage(derive(spark, d, inputs.CLEAN_TABLES[n]), n, RUN_ID, RUN_TIME)
        for n in names
    }


def _no_lineage(df: DataFrame) -> DataFrame:
    return df.drop("source_file_path", "run_id", "processed_at")


# --- sources and sinks ------------------------------------------------------------


@query
def scan_delimited(spark, d):
    folder = new_folder(spark, "orders-tsv")
    table(spark, d, "orders").select(
        "o_orderkey",
        "o_custkey",
        "o_orderstatus",
        F.to_date("o_orderdate").alias("o_orderday"),
        "o_orderpriority",
    ).write.csv(folder, sep="\t", header=True)
    return read_delimited(spark, folder)


def _ragged_orders(spark: SparkSession, d: str) -> str:
    """Orders as text, some rows with a cell too few and some with one too many."""
    folder = new_folder(spark, "ragged-tsv")
    key = F.col("o_orderkey")
    cells = [key.cast("string"), F.col("o_custkey").cast("string"), F.col("o_orderstatus")]
    row = (
        F.when(key % 10 == 1, F.concat_ws("\t", *cells[:2]))
        .when(key % 10 == 2, F.concat_ws("\t", *cells, F.lit("more")))
        .otherwise(F.concat_ws("\t", *cells))
    )
    files = int(spark.conf.get("spark.sql.shuffle.partitions"))
    part = F.pmod(F.xxhash64("o_orderkey"), F.lit(files)).cast("int")
    body = table(spark, d, "orders").select(
        part.alias("part"), F.lit(1).alias("place"), row.alias("value")
    )
    # Every file begins with the header.
    top = F.lit("o_orderkey\to_custkey\to_orderstatus")
    tops = body.select("part").distinct().select(
        "part", F.lit(0).alias("place"), top.alias("value")
    )
    tops.unionAll(body).repartition("part").sortWithinPartitions("part", "place").select(
        "part", "value"
    ).write.partitionBy("part").text(folder)
    return folder


@query
def scan_ragged(spark, d):
    """Rows of another number of cells are padded or cut, and their text is kept."""
    read = read_delimited(spark, _ragged_orders(spark, d), malformed="row_text")
    return read.select("o_orderkey", "o_custkey", "o_orderstatus", "row_text")


@query
def issues_malformed(spark, d):
    """The same rows through a table declaration: kept, with an issue each."""
    spec = TableSpec(
        "orders", "SHOP", "orders.txt", required=("o_orderkey",), key=("o_orderkey",)
    )
    clean, found = spec.build(spark, _ragged_orders(spark, d), RUN_ID, RUN_TIME)
    kept = clean.select(
        F.lit("row").alias("entry"), F.col("o_orderkey").alias("record_key"),
        F.col("o_orderstatus").alias("raw_value"),
    )
    return kept.unionAll(found.select("rule_name", "record_key", "raw_value"))


@query
def header_offset_read(spark, d):
    """Customers in several files, each with three junk rows above its header.

    Every second file has its columns in the opposite order. Cells hold line breaks,
    blank lines and quotes, in the junk as well.
    """
    folder = new_folder(spark, "customer-preamble")
    files = int(spark.conf.get("spark.sql.shuffle.partitions"))
    cells = ["c_custkey", "c_name", "", "c_nationkey", "c_mktsegment"]
    name = F.when(
        F.col("c_custkey") % 10 == 3,
        F.concat(F.lit('"'), F.col("c_name"), F.lit('\n\nthe ""second"" line"')),
    ).otherwise(F.col("c_name"))

    def line(values) -> Column:
        return F.concat_ws("\t", *values)

    def either(values) -> Column:
        return F.when(F.col("part") % 2 == 0, line(values)).otherwise(line(values[::-1]))

    row = either([F.col(c) if c else F.lit("") for c in cells])
    body = (
        table(spark, d, "customer")
        .withColumn("c_name", name)
        .withColumn(
            "part", F.pmod(F.xxhash64("c_custkey"), F.lit(files)).cast("int")
        )
        .select(
            "part",
            F.lit(1).alias("place"),
            F.explode(
                F.when(F.col("c_custkey") % 50 == 0, F.array(row, F.lit("\t\t\t\t")))
                .otherwise(F.array(row))
            ).alias("value"),
        )
    )
    header = either([F.lit(c) for c in cells])
    top = [F.lit("Customers"), F.lit(""), F.lit('"not\n\ndata"\tnor this'), header]
    preamble = (
        body.select("part")
        .distinct()
        .select("part", F.posexplode(F.array(*top)).alias("line", "value"))
        .select("part", (F.col("line") - 10).alias("place"), "value")
    )
    lines = preamble.unionByName(body)
    lines.repartition("part").sortWithinPartitions("part", "place").select(
        "part", "value"
    ).write.partitionBy("part").text(folder)
    read = read_with_header_offset(spark, folder, header_row=3)
    return read.select(*[c for c in cells if c])


@query
def file_manifest(spark, d):
    """Rows of every base table from the metadata of its scanned rows."""
    scans = [
        scanned_files(table(spark, d, n)).select(
            F.lit(n).alias("table_name"), "n_rows", "bytes_written"
        )
        for n in inputs.TABLES
    ]
    return (
        reduce(DataFrame.unionAll, scans)
        .groupBy("table_name")
        .agg(
            F.sum("n_rows").alias("n_rows"),
            F.bool_and(F.col("bytes_written") > 0).alias("all_have_content"),
        )
    )


@query
def required_source_gate(spark, d):
    """Expected tables, with the rows scanned from those that are there."""
    expected = [ExpectedFile("tables", "", f"{n}.parquet") for n in inputs.TABLES] + [
        ExpectedFile("tables", "", "returns.parquet"),
        ExpectedFile("tables", "", "notes.parquet", required=False),
        # A file of this name is there, but not in this group's folder.
        ExpectedFile("tables", "other", "orders.parquet"),
    ]
    scans = [
        scanned_files(table(spark, d, n)).select(
            F.lit(f"{n}.parquet").alias("file_name"), "n_rows"
        )
        for n in inputs.TABLES
    ]
    rows = (
        reduce(DataFrame.unionAll, scans).groupBy("file_name").agg(F.sum("n_rows").alias("n_rows"))
    )
    listed = scanned_manifest(spark, expected, rows)
    missing = F.lit(True).alias("missing")
    gate = missing_required(listed).select("source_group", "file_name", missing)
    return listed.join(gate, ["source_group", "file_name"], "left").select(
        "source_group",
        "file_name",
        "download_status",
        "n_rows",
        F.coalesce("missing", F.lit(False)).alias("stops_the_run"),
    )


@query
def sink_overwrite_append(spark, d):
    """Two overwrites and an append; the table goes when its rows have been counted."""
    name = f"events_{uuid.uuid4().hex[:8]}"
    path = new_folder(spark, name)
    events = table(spark, d, "events").select("event_id", "user_id", "event_type")
    write_table(events.limit(0), name, "overwrite", partition_by=["event_type"], path=path)
    write_table(events, name, "overwrite", partition_by=["event_type"], path=path)
    write_table(events, name, "append", partition_by=["event_type"], path=path)
    counts = spark.table(name).groupBy("event_type").agg(F.count("*").alias("n_rows"))
    result = stage(counts, name)
    spark.sql(f"DROP TABLE {name}")
    return result


@query
def json_flatten(spark, d):
    return table(spark, d, "events").select(
        "event_id", F.from_json("props", "k BIGINT")["k"].alias("k")
    )


@query
def series_flatten(spark, d):
    """One response document per event; every seventh request failed."""

    def point(period: str, value: str):
        return F.struct(
            F.date_format("ts", "yyyy").alias("year"),
            F.lit(period).alias("period"),
            F.col(value).cast("string").alias("value"),
            F.array(
                F.struct(F.lit("1").alias("code")), F.struct(F.lit("2").alias("code"))
            ).alias("footnotes"),
        )

    series = F.struct(
        F.col("event_type").alias("seriesID"),
        F.array(point("M01", "event_id"), point("M02", "user_id")).alias("data"),
    )
    status = F.when(F.col("event_id") % 7 == 0, "REQUEST_NOT_PROCESSED").otherwise(
        "REQUEST_SUCCEEDED"
    )
    documents = table(spark, d, "events").select(
        F.to_json(
            F.struct(
                status.alias("status"),
                F.struct(F.array(series).alias("series")).alias("Results"),
            )
        ).alias("value")
    )
    return flatten_responses(documents).drop("period_name")


@query
def latest_per_series(spark, d):
    events = table(spark, d, "events").select("user_id", "event_id", "event_type", "ts")
    return latest(events, ["user_id"], ["ts", "event_id"]).select(
        "user_id", "event_id", "event_type"
    )


# --- projection and cleaning ------------------------------------------------------


@query
def normalize_headers_query(spark, d):
    return table(spark, d, "part").select(
        F.col("p_partkey").alias(" P*Part-Key "),
        F.col("p_name").alias("Name (full), text"),
        F.col("p_brand").alias("Brand/Label [2]"),
        F.col("p_size").alias("Size %"),
    ).transform(normalize_headers)


@query
def trim_and_nullify(spark, d):
    return _clean_strings(_dirty_orders(spark, d))


@query
def lineage_columns(spark, d):
    lines = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber")
    return with_lineage(lines, "lineitem", RUN_ID, RUN_TIME).drop("processed_at")


@query
def mapped_projection(spark, d):
    mapped = select_mapped(
        table(spark, d, "customer").withColumn("c_segment_raw", F.col("c_mktsegment")),
        required={"key": ("cust_id", "c_custkey"), "name": ("c_name",)},
        optional={
            "segment": ("c_mktsegment",),
            "segment_raw": ("c_segment_raw",),
            "phone": ("c_phone", "phone"),
        },
    )
    return select_existing(mapped, ["name", "fax", "key", "segment", "segment_raw"])


@query
def required_filter(spark, d):
    cleaned = _clean_strings(_dirty_orders(spark, d))
    kept = keep_required(cleaned, ["raw_code", "raw_amount", "absent"])
    return kept.select("o_orderkey", "raw_code", "raw_amount")


@query
def base_frame_query(spark, d):
    folder = new_folder(spark, "dirty-orders-tsv")
    _dirty_orders(spark, d).withColumnsRenamed(
        {"o_orderkey": "Order*Key", "raw_code": "Raw Code", "raw_amount": "Raw, amount",
         "raw_flag": "RAW-FLAG", "raw_month": "raw__month", "raw_zone": "Raw/Zone"}
    ).write.csv(
        folder,
        sep="\t",
        header=True,
        ignoreLeadingWhiteSpace=False,
        ignoreTrailingWhiteSpace=False,
    )
    return base_frame(read_delimited(spark, folder), "orders", RUN_ID, RUN_TIME).drop(
        "processed_at"
    )


# --- scalar expressions -----------------------------------------------------------


@query
def normalize_base_code(spark, d):
    coded = add_codes(
        _dirty_orders(spark, d).select("o_orderkey", "raw_code"), base_from="raw_code"
    )
    return coded.withColumnRenamed("soc_code", "code")


@query
def normalize_detail_code(spark, d):
    dirty = _dirty_orders(spark, d).select(
        "o_orderkey", F.col("raw_code").alias("onet_soc_code")
    )
    return split_detailed_code(dirty).toDF("o_orderkey", "raw_code", "detail", "base")


@query
def yes_no_flag(spark, d):
    return _dirty_orders(spark, d).select(
        "o_orderkey", yes_no(F.col("raw_flag")).alias("flag")
    )


@query
def amount_qualifier_query(spark, d):
    raw = F.col("raw_amount")
    return _clean_strings(_dirty_orders(spark, d)).select(
        "o_orderkey",
        raw,
        amount_qualifier(raw).alias("qualifier"),
        safe_cast(amount_text(raw), "bigint").alias("amount"),
    )


@query
def safe_cast_query(spark, d):
    amount = safe_cast(F.col("raw_amount"), "bigint")
    return _dirty_orders(spark, d).select(
        "o_orderkey",
        amount.alias("amount"),
        (F.col("raw_amount").isNotNull() & amount.isNull()).alias("is_failure"),
    )


@query
def source_month_query(spark, d):
    return _dirty_orders(spark, d).select(
        "o_orderkey", "raw_month", source_month(F.col("raw_month")).alias("data_month")
    )


@query
def period_calendar(spark, d):
    return derive(spark, d, inputs.PERIODS).select(
        "o_orderkey",
        "period",
        period_type(F.col("period")).alias("period_type"),
        observation_date(F.col("yr"), F.col("period")).alias("observation_date"),
    )


@query
def thousands_to_count_query(spark, d):
    return table(spark, d, "part").select(
        "p_partkey", thousands_to_count(F.col("p_retailprice")).alias("units")
    )


@query
def direction_label(spark, d):
    """Balances in cents against the mean of the segment."""
    cents = F.round(F.col("c_acctbal") * 100).cast("bigint")
    customer = table(spark, d, "customer").select("c_mktsegment", cents.alias("cents"))
    # A segment is a small dimension: its mean is aggregated, then looked up.
    means = customer.groupBy("c_mktsegment").agg(
        (F.sum("cents") / F.count("cents")).alias("mean")
    )
    return (
        customer.join(means, "c_mktsegment")
        .select("c_mktsegment", direction(F.col("cents") - F.col("mean")).alias("label"))
        .groupBy("c_mktsegment", "label")
        .agg(F.count("*").alias("n"))
    )


@query
def level_label(spark, d):
    zone = (F.col("p_size") % 7).cast("int")
    scale = F.when(zone < 2, "im").when(zone < 4, "LV").otherwise("CX")
    return (
        table(spark, d, "part")
        .select(
            preparation_label(zone).alias("zone_label"),
            scale_label(scale).alias("scale_name"),
        )
        .groupBy("zone_label", "scale_name")
        .agg(F.count("*").alias("n"))
    )


@query
def record_key_query(spark, d):
    cleaned = _clean_strings(_dirty_orders(spark, d))
    parts = ["o_orderkey", "raw_code", "raw_flag"]
    return cleaned.select("o_orderkey", record_key(parts).alias("record_key"))


@query
def row_hash_query(spark, d):
    lines = derive(spark, d, inputs.DIRTY_LINEITEM)
    return lines.select(
        "l_orderkey", "l_linenumber", row_hash(lines.columns).alias("row_hash")
    )


# --- checks that write issues, and deduplication ----------------------------------

ORDER_FIELDS = (
    Field("order_key", ("o_orderkey",), required=True),
    Field("code_raw", ("raw_code",), required=True),
    Field("code", ("raw_code",), required=True, via=base_code),
    Field("amount", ("raw_amount",), required=True, via=amount_text),
    Field("amount_raw", ("raw_amount",), required=True),
    Field("amount_qualifier", ("raw_amount",), required=True, via=amount_qualifier),
    Field("flag", ("raw_flag",), via=yes_no),
    Field("month", ("raw_month",), via=source_month),
    Field("zone", ("raw_zone",)),
)
ORDER_CASTS = {"amount": "bigint", "zone": "int"}
ORDER_KEY = ("code", "zone")
ORDER_REQUIRED = ("code", "amount", "approved_by")
ORDER_RULES = (
    Matches("code_raw", BASE_CODE_PATTERN, ("order_key",)),
    InRange("zone", 1, 5, "code", "invalid_zone", "Zone must be between 1 and 5."),
)


def _dataset(name: str) -> Dataset:
    return Dataset(RUN_ID, "tables", name, f"{name}.parquet", RUN_TIME)


def _order_rows(spark: SparkSession, d: str) -> DataFrame:
    dirty = derive(spark, d, inputs.REPEATED_ORDERS)
    return select_fields(_clean_strings(dirty), ORDER_FIELDS)


def _finished_orders(spark: SparkSession, d: str) -> Finished:
    dataset = _dataset("orders")
    annotated, missing = check(
        _order_rows(spark, d),
        dataset,
        ORDER_REQUIRED,
        ORDER_KEY,
        ORDER_CASTS,
        ("order_key", "zone"),
        ORDER_RULES,
    )
    return Finished.of(annotated, missing, ORDER_REQUIRED, ORDER_KEY, dataset)


def _issues(df: DataFrame) -> DataFrame:
    return df.select(*ISSUE_COLUMNS)


@query
def issues_required(spark, d):
    dataset = _dataset("orders")
    rows = _order_rows(spark, d)
    rules = [Required(c, ("order_key",)) for c in ORDER_REQUIRED]
    found = issue_rows(annotate(rows, rules=rules), dataset)
    missing = missing_column_rows(spark, rows.columns, ORDER_REQUIRED, dataset)
    return _issues(union_issues(spark, [found, missing, None]))


@query
def issues_regex(spark, d):
    rule = Matches("code_raw", BASE_CODE_PATTERN, ("order_key",), "warning")
    annotated = annotate(_order_rows(spark, d), rules=[rule])
    return _issues(issue_rows(annotated, _dataset("orders")))


@query
def issues_cast(spark, d):
    annotated = annotate(_order_rows(spark, d), ORDER_CASTS, ("order_key", "zone"))
    return _issues(issue_rows(annotated, _dataset("orders")))


@query
def issues_range(spark, d):
    rule = InRange(
        "p_size", 1, 40, "p_partkey", "invalid_size", "Size must be between 1 and 40."
    )
    annotated = annotate(table(spark, d, "part"), rules=[rule])
    return _issues(issue_rows(annotated, _dataset("part")))


@query
def issues_duplicate(spark, d):
    lines = derive(spark, d, inputs.DIRTY_LINEITEM)
    return _issues(
        duplicate_issues(lines, ["l_orderkey", "l_linenumber"], _dataset("lineitem"))
    )


@query
def dedup_keep_min_hash(spark, d):
    return deduplicate(
        derive(spark, d, inputs.DIRTY_LINEITEM), ["l_orderkey", "l_linenumber"]
    )


@query
def dedup_by_places(spark, d):
    """The same rows chosen as numbers from a stage and fetched afterwards."""
    rows = placed(derive(spark, d, inputs.DIRTY_LINEITEM), "dedup_by_places")
    return chosen_rows(rows, choose_rows(rows, ["l_orderkey", "l_linenumber"]))


@query
def finish_table(spark, d):
    return _finished_orders(spark, d).clean()


@query
def issues_union_summary(spark, d):
    """All issues of the orders table, by rule."""
    issues = _finished_orders(spark, d).issues()
    return (
        union_issues(spark, [issues, empty_issues(spark)])
        .groupBy("rule_name", "severity")
        .agg(F.count("*").alias("n_issues"))
    )


@query
def audit_summary(spark, d):
    audit = Audit(RUN_ID)
    for name in ("orders", "lineitem", "customer"):
        target = f"{name}_{uuid.uuid4().hex[:8]}"
        audit.write(
            table(spark, d, name), "tables", target, path=new_folder(spark, target)
        )
        if count_rows(spark, target) != audit.rows[-1][4]:
            raise RuntimeError(f"The observed row count of {name} is wrong")
    return newest_first(audit.frame(spark), "started_at").select(
        "run_id",
        "source_system",
        F.substring_index("table_name", "_", 1).alias("table_name"),
        "status",
        "row_count",
        "write_mode",
        "error_message",
    )


# --- dimensional views ------------------------------------------------------------


@query
def dimension_build(spark, d):
    return gold.code_dimension(
        {name: derive(spark, d, text) for name, text in inputs.PLACES.items()},
        {f"has_{name}_data": name for name in inputs.PLACES},
        counted="customer",
        title="title",
        count_name="customer_count",
    )


@query
def occupation_dimension(spark, d):
    return gold.dim_occupation(
        _clean_tables(
            spark,
            d,
            "bls_employment_projections",
            "bls_oews_occupations",
            "onet_occupations",
        )
    )


def _star_fact(spark: SparkSession, d: str) -> DataFrame:
    return gold.fact_oews_measurement(
        _clean_tables(
            spark,
            d,
            "bls_oews_observations",
            "bls_oews_series",
            "bls_oews_occupations",
            "bls_oews_areas",
            "bls_oews_industries",
            "bls_oews_datatypes",
        )
    )


@query
def star_fact(spark, d):
    return _no_lineage(_star_fact(spark, d))


def _projection_fact(spark: SparkSession, d: str) -> DataFrame:
    return gold.fact_occupation_projection(
        _clean_tables(spark, d, "bls_employment_projections")
    )


@query
def projection_fact(spark, d):
    return _no_lineage(_projection_fact(spark, d))


def _education(spark: SparkSession, d: str, ranked: bool = True) -> DataFrame:
    return gold.bridge_occupation_education(
        _clean_tables(
            spark, d, "onet_education", "onet_education_categories", "onet_occupations"
        ),
        ranked,
    )


def _skills(spark: SparkSession, d: str, ranked: bool = True) -> DataFrame:
    return gold.bridge_occupation_skill(
        _clean_tables(
            spark,
            d,
            "onet_essential_skills",
            "onet_transferable_skills",
            "onet_occupations",
        ),
        ranked,
    )


def _software(spark: SparkSession, d: str) -> DataFrame:
    return gold.bridge_occupation_software(
        _clean_tables(spark, d, "onet_software_skills", "onet_occupations")
    )


def _zones(spark: SparkSession, d: str) -> DataFrame:
    return gold.bridge_occupation_job_zone(
        _clean_tables(spark, d, "onet_job_zones", "onet_occupations")
    )


@query
def bridge_distribution(spark, d):
    return _no_lineage(_education(spark, d))


@query
def bridge_family_rank(spark, d):
    return _no_lineage(_skills(spark, d))


@query
def bridge_family_rank_large_groups(spark, d):
    """Skills ranked over all occupations: six groups of very different size."""
    skills = _skills(spark, d, ranked=False).select(
        "onet_soc_code", "skill_family", "skill_id", "scale_id", "skill_score"
    )
    return dense_rank(
        skills,
        ["skill_family", "scale_id"],
        [("skill_score", "desc"), ("onet_soc_code", "asc"), ("skill_id", "desc")],
        "skill_rank",
    )


@query
def rank_hot_group(spark, d):
    """Three groups hold all rows: ranked by ranges of values, not in three tasks."""
    lines = table(spark, d, "lineitem").select(
        "l_returnflag", "l_orderkey", "l_linenumber", "l_partkey"
    )
    return dense_rank(
        lines, ["l_returnflag"], [("l_partkey", "desc"), ("l_linenumber", "asc")]
    )


@query
def rank_common_prefix(spark, d):
    """Texts that all begin alike, in three groups."""
    address = F.concat(
        F.lit("https://parts.example/"), F.lpad(F.col("l_partkey").cast("string"), 12, "0")
    )
    lines = table(spark, d, "lineitem").select(
        "l_returnflag", "l_orderkey", "l_linenumber", address.alias("address")
    )
    return dense_rank(
        lines, ["l_returnflag"], [("address", "asc"), ("l_linenumber", "desc")]
    )


@query
def rank_one_day(spark, d):
    """Times of one day, all in one group."""
    second = (F.col("l_orderkey") * 7 + F.col("l_linenumber")) % 86400
    lines = table(spark, d, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        F.timestamp_seconds(F.lit(1704067200) + second).alias("at"),
    )
    return dense_rank(lines, [], [("at", "desc")]).drop("at")


@query
def bridge_distinct(spark, d):
    return _no_lineage(_software(spark, d))


@query
def bridge_label(spark, d):
    return _no_lineage(_zones(spark, d))


# --- checks on finished tables ----------------------------------------------------


@query
def check_unique_key(spark, d):
    return checks.repeated_keys(
        table(spark, d, "lineitem"), ["l_orderkey", "l_linenumber"]
    )


@query
def check_null_counts(spark, d):
    cleaned = _clean_strings(_dirty_orders(spark, d))
    return checks.null_counts(
        cleaned, {"null_codes": "raw_code", "null_amounts": "raw_amount",
                  "null_flags": "raw_flag"}
    )


@query
def check_lookup_hits(spark, d):
    return checks.lookup_hits(
        _star_fact(spark, d),
        {
            "rows_with_occupation_name": "occupation_name",
            "rows_with_area_name": "area_name",
            "rows_with_industry_name": "industry_name",
            "rows_with_datatype_name": "datatype_name",
        },
        total="total_oews_rows",
    )


@query
def check_match_counts(spark, d):
    return checks.match_counts(
        table(spark, d, "orders"),
        derive(spark, d, inputs.HOLED_LOOKUP),
        "o_custkey",
        "c_custkey",
    )


@query
def unmatched_rows(spark, d):
    return checks.unmatched_rows(
        table(spark, d, "orders").select("o_orderkey", "o_custkey"),
        derive(spark, d, inputs.HOLED_LOOKUP),
        "o_custkey",
        "c_custkey",
    )


@query
def check_coverage(spark, d):
    nation = table(spark, d, "nation").select("n_nationkey", "n_name")
    customer = table(spark, d, "customer").select("c_custkey", "c_nationkey")
    supplier = table(spark, d, "supplier").select("s_suppkey", "s_nationkey")
    orders = table(spark, d, "orders").select("o_orderkey", "o_custkey")
    lines = table(spark, d, "lineitem").select("l_partkey", "l_suppkey")
    return checks.coverage(
        nation,
        "n_nationkey",
        {
            "customers": (customer, "c_nationkey", "c_custkey"),
            "suppliers": (supplier, "s_nationkey", "s_suppkey"),
            "orders": (
                orders.join(customer, orders.o_custkey == customer.c_custkey),
                "c_nationkey",
                "o_orderkey",
            ),
            "parts": (
                lines.join(supplier, lines.l_suppkey == supplier.s_suppkey),
                "s_nationkey",
                "l_partkey",
            ),
        },
    ).orderBy("n_nationkey")


@query
def bridge_coverage(spark, d):
    """Coverage of the coded titles by all four bridges."""
    dimension = occupation_dimension(spark, d).select("soc_code", "occupation_title")
    bridges = {
        "onet_occupations_with_education": _education(spark, d, ranked=False),
        "onet_occupations_with_skills": _skills(spark, d, ranked=False),
        "onet_occupations_with_software": _software(spark, d),
        "onet_occupations_with_job_zone": _zones(spark, d),
    }
    return checks.coverage(
        dimension,
        "soc_code",
        {name: (df, "soc_code", "onet_soc_code") for name, df in bridges.items()},
    )


# --- metric layer -----------------------------------------------------------------


def _board(spark: SparkSession, d: str) -> MetricView:
    return board.projection_metrics(_projection_fact(spark, d))


@query
def metric_counters(spark, d):
    return board.counters(_board(spark, d)).withColumn(
        "avg_median_wage", F.round("avg_median_wage", 4)
    )


@query
def metric_by_dimension(spark, d):
    """Order totals by priority, for finished orders of chosen facets."""
    orders = table(spark, d, "orders").withColumn(
        "cents", F.round(F.col("o_totalprice") * 100).cast("bigint")
    )
    view = MetricView(
        source=orders,
        filter="o_orderstatus = 'F'",
        measures={
            "n_orders": "count(*)",
            "total_cents": "sum(cents)",
            "mean_cents": "round(sum(cents) / count(*), 2)",
        },
        dimensions={
            "priority": "o_orderpriority",
            "order_year": "year(o_orderdate)",
        },
    )
    return view.query(
        ["n_orders", "total_cents", "mean_cents"],
        ["priority"],
        facets={"order_year": [1996, 1997, 1998]},
        where=lambda dimensions: dimensions["priority"] != "5-LOW",
    )


@query
def top_growth(spark, d):
    return board.fastest_growing(_board(spark, d))


@query
def top_measure_groups(spark, d):
    return board.most_openings(_board(spark, d))


@query
def top_paying(spark, d):
    return board.highest_paying(_board(spark, d))


@query
def top_customers(spark, d):
    customer = table(spark, d, "customer")
    view = MetricView(
        source=customer,
        measures={},
        dimensions={"balance": "c_acctbal", "name": "c_name", "key": "c_custkey"},
    )
    return view.top_rows("balance", ["name", "key"], 20)


@query
def scatter_rows(spark, d):
    return board.wage_and_growth(_board(spark, d))


@query
def details_table(spark, d):
    return board.details(_board(spark, d))


@query
def facet_counts(spark, d):
    return board.facet_values(
        _board(spark, d),
        {
            "growth_direction": ["growing", "unknown"],
            "typical_entry_education": ["Brand#11", "Brand#2", None],
        },
    )


@query
def order_metrics(spark, d):
    """From dirty order text to a ranking, through every layer."""
    view = MetricView(
        source=_finished_orders(spark, d).clean(),
        filter=F.col("amount_qualifier") != "less_than",
        measures={"total_amount": "sum(amount)", "n_orders": "count(*)"},
        dimensions={"code": "code", "qualifier": "amount_qualifier"},
    )
    return view.top_groups("total_amount", ["code"], 15)
