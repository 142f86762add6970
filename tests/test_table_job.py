from __future__ import annotations

import pytest
from pyspark.sql import functions as F
from source_files import write_sources

from strata.operators import checks
from strata.plans import (
    board,
    gold,
    gold_checks,
    gold_views,
    occupation_tables,
    survey_tables,
)
from strata.plans.spec import TableSpec
from strata.plans.table_job import AUDIT_TABLE, ISSUE_TABLE, TableJob, newest_first
from strata.sources.tables import write_table

SPECS = (*survey_tables.SPECS, *occupation_tables.SPECS)


@pytest.fixture(scope="module")
def paths(tmp_path_factory):
    return write_sources(tmp_path_factory.mktemp("sources"))


@pytest.fixture(scope="module")
def run(spark, paths):
    return TableJob(spark).run(SPECS, paths)


@pytest.fixture(scope="module")
def tables(spark, run):
    return gold.clean_tables(spark, [s.name for s in SPECS])


def issues(spark, run, name, *columns):
    found = spark.table(ISSUE_TABLE).filter(
        f"run_id = '{run.run_id}' AND dataset_name = '{name}'"
    )
    columns = columns or ("rule_name", "record_key", "raw_value")
    return sorted((tuple(r) for r in found.select(*columns).collect()), key=repr)


def test_every_table_is_written_and_audited(spark, run):
    assert len(SPECS) == 24
    audit = spark.table(AUDIT_TABLE).filter(f"run_id = '{run.run_id}'").collect()
    assert {r.table_name for r in audit} == {s.name for s in SPECS}
    for row in audit:
        assert (row.status, row.write_mode, row.error_message) == (
            "success", "overwrite", None,
        )
        assert row.row_count == spark.table(row.table_name).count()
        assert row.started_at <= row.completed_at
    newest = newest_first(spark.table(AUDIT_TABLE), "started_at").first()
    assert newest.table_name == SPECS[-1].name
    assert spark.table(ISSUE_TABLE).filter(f"run_id = '{run.run_id}'").count() == (
        run.issue_count
    )


def test_keys_are_unique_and_required_values_present(tables):
    for spec in SPECS:
        df = tables[spec.name]
        key = [k for k in spec.key if k in df.columns]
        assert checks.repeated_keys(df, key).count() == 0, spec.name
        required = {c: c for c in spec.required}
        assert set(checks.null_counts(df, required).first()) <= {0}, spec.name


def test_rows_of_a_run_share_one_clock(spark, run, tables):
    clocks = {
        r[0] for n in ("bls_oews_series", "onet_knowledge")
        for r in tables[n].select("processed_at").collect()
    }
    detected = {r[0] for r in spark.table(ISSUE_TABLE).filter(
        f"run_id = '{run.run_id}'").select("detected_at").collect()}
    assert clocks == detected and len(clocks) == 1


def test_observations(spark, run, tables):
    got = {
        (r.series_id, r.year, r.period): (r.value, r.value_raw, r.footnote_codes)
        for r in tables["bls_oews_observations"].collect()
    }
    assert got[("S1", 2023, "A01")] == (1234.5, "1234.5", None)
    assert got[("S1", 2024, "M03")] == (1300.0, "$1,300", "5")
    assert len(got) == 7
    found = issues(spark, run, "bls_oews_observations")
    assert found == sorted(
        [
            ("invalid_format", "S4|2023|Q01", "Q01"),
            ("invalid_type_cast", "S4|<null>|A01", "20x3"),
            ("invalid_type_cast", "S5|2023|A01", "*"),
            ("missing_required_value", "S4|<null>|A01", "year"),
            ("missing_required_value", "<null>|2023|A01", "series_id"),
            ("exact_duplicate_key", "S2|2023|S02", "2"),
            ("conflicting_duplicate_key", "S3|2023|A01", "2"),
            ("conflicting_duplicate_key", "S5|2023|A01", "2"),
        ],
        key=repr,
    )


def test_projections(spark, run, tables):
    got = {r.soc_code: r for r in tables["bls_employment_projections"].collect()}
    chief = got["11-1011"]
    assert chief.median_annual_wage == 239200.0
    assert chief.median_annual_wage_raw == ">=$239,200"
    assert chief.median_annual_wage_qualifier == "greater_than_or_equal"
    assert got["00-0000"].employment_base_year_thousands == 1000.4
    assert got["15-0000"].typical_entry_education is None
    found = issues(spark, run, "bls_employment_projections")
    assert ("invalid_type_cast", "29-1141", "abc") in found
    assert ("invalid_format", "29-1141-99", "29-1141-99") in found
    assert ("conflicting_duplicate_key", "29-1141|Line item", "2") in found
    assert ("missing_required_value", "<null>|<null>", "soc_code") in found


def test_lookup_tables_keep_all_source_columns(tables):
    assert set(tables["bls_oews_areas"].columns) >= {
        "state_code", "area_code", "areatype_code", "area_name", "run_id",
    }


def test_code_and_zone_checks(spark, run):
    assert ("invalid_job_zone", "11-1011.00", "7") in issues(spark, run, "onet_job_zones")
    assert ("invalid_format", "<null>", "99-99") in issues(spark, run, "onet_occupations")
    related = issues(spark, run, "onet_related_occupations")
    assert ("invalid_format", "15-1252.00|11-1011", "11-1011") in related
    assert ("invalid_type_cast", "11-1011.00|15-1252.00", "three") in related


def test_flags_and_months(tables):
    software = {r.software_name: r for r in tables["onet_software_skills"].collect()}
    assert (software["Python"].hot_technology, software["Python"].in_demand) == (True, None)
    task = tables["onet_task_statements"].first()
    assert (task.task_id, str(task.data_month), task.source_date_raw) == (
        21666, "2023-08-01", "08/2023",
    )
    assert tables["onet_education"].first().data_month is None


@pytest.fixture(scope="module")
def views(tables):
    return gold.build_views(tables)


@pytest.mark.parametrize("name", list(gold.VIEWS))
def test_catalog_views_equal_the_frames(spark, views, rows, name):
    spark.sql("CREATE DATABASE IF NOT EXISTS gold_test")
    gold_views.publish(spark, gold="gold_test", names=[name])
    view = spark.table(f"gold_test.{name}")
    assert view.columns == views[name].columns
    assert dict(view.dtypes) == dict(views[name].dtypes)
    assert rows(view) == rows(views[name])
    described = spark.sql(f"DESCRIBE TABLE EXTENDED gold_test.{name}")
    assert described.filter("col_name = 'Comment'").count() == 1


def test_ranks_of_a_view_take_one_shuffle_of_the_rows(spark, rows):
    spark.sql("CREATE DATABASE IF NOT EXISTS ranks")
    codes = [None, "11-1011.00", "11-1012.00"]
    data = [
        (codes[i % 3], "11-1011", f"e{i}", None if i % 5 == 0 else f"n{i % 4}",
         None if i % 7 == 0 else "IM", float(i % 11), "f", "r", None)
        for i in range(400)
    ]
    data += [(None, "s", "e", "n", None, v, "f", "r", None) for v in (float("nan"), -0.0, -2.5)]
    ddl = (
        "onet_soc_code string, soc_code string, element_id string, element_name string, "
        "scale_id string, data_value double, source_file_path string, run_id string, "
        "processed_at timestamp"
    )
    skills = spark.createDataFrame(data, ddl)
    titles = spark.createDataFrame(
        [("11-1011.00", "Chief"), ("11-1011.00", "Head"), (None, "Nobody")],
        "onet_soc_code string, occupation_title string",
    )
    write_table(titles, "ranks.onet_occupations")
    for name in ("onet_essential_skills", "onet_transferable_skills"):
        write_table(skills, f"ranks.{name}")
    gold_views.publish(spark, "ranks", "ranks", ["bridge_occupation_skill"])
    view = spark.table("ranks.bridge_occupation_skill")
    tables = gold.clean_tables(
        spark,
        ["onet_occupations", "onet_essential_skills", "onet_transferable_skills"],
        "ranks",
    )
    # NaN is not equal to itself.
    assert list(map(repr, rows(view))) == list(map(repr, rows(gold.bridge_occupation_skill(tables))))
    limit = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(limit)
    spark.conf.set(limit, "-1")
    try:
        plan = view._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set(limit, before)
    # Values by step, steps by group and by step, rows by step and by code; and the titles.
    assert plan.count("Exchange hashpartitioning") == 6
    assert "HashAggregate" not in plan


def test_a_view_reads_what_the_last_write_left(spark):
    spark.sql("CREATE DATABASE IF NOT EXISTS fresh")
    zones = spark.createDataFrame(
        [("11-1011.00", "11-1011", 4, "f", "r", None)],
        "onet_soc_code string, soc_code string, job_zone int, source_file_path string, "
        "run_id string, processed_at timestamp",
    )
    titles = spark.createDataFrame(
        [("11-1011.00", "Chief", "Leads")],
        "onet_soc_code string, occupation_title string, description string",
    )
    write_table(titles, "fresh.onet_occupations")
    write_table(zones, "fresh.onet_job_zones")
    gold_views.publish(spark, "fresh", "fresh", ["bridge_occupation_job_zone"])
    view = "fresh.bridge_occupation_job_zone"
    assert spark.table(view).first().job_zone_label == "high_preparation"
    write_table(zones, "fresh.onet_job_zones", "append")
    assert spark.table(view).count() == 2
    write_table(zones.withColumn("job_zone", F.lit(9)), "fresh.onet_job_zones")
    assert [r.job_zone_label for r in spark.table(view).collect()] == ["unknown"]


def test_dimension(views):
    got = {r.soc_code: r for r in views["dim_occupation"].collect()}
    dev = got["15-1252"]
    assert dev.occupation_title == "Software developers"
    assert (dev.major_group_code, dev.major_group_title) == (
        "15-0000", "Computer occupations",
    )
    assert dev.onet_occupation_count == 2
    assert (dev.has_employment_projection_data, dev.has_oews_data, dev.has_onet_data) == (
        True, True, True,
    )
    movers = got["53-7199"]
    assert (movers.occupation_title, movers.major_group_title) == ("Movers", None)
    assert (movers.has_oews_data, movers.has_onet_data) == (False, True)


def test_star_fact(views):
    got = {(r.series_id, r.period): r for r in views["fact_oews_measurement"].collect()}
    row = got[("S2", "S02")]
    assert (row.period_type, str(row.observation_date)) == ("semiannual", "2023-07-01")
    assert (row.area_name, row.area_lookup_record_count) == ("Birmingham", 2)
    assert row.soc_code == "11-1011"
    assert ("S9", "A01") not in got
    assert got[("S4", "Q01")].observation_date is None


def test_bridges(views):
    education = {
        (r.onet_soc_code, r.category): r
        for r in views["bridge_occupation_education"].collect()
    }
    first = education[("15-1252.00", 1)]
    assert (first.education_rank, first.is_primary_education_category) == (1, True)
    assert education[("15-1252.00", 8)].education_category is None
    skills = views["bridge_occupation_skill"].filter("skill_family = 'essential'")
    ranks = {
        (r.onet_soc_code, r.skill_id, r.scale_name): r.skill_rank for r in skills.collect()
    }
    assert ranks[("15-1252.00", "2.A.1.b", "importance")] == 2
    assert ranks[("15-1252.00", "2.A.1.c", "importance")] == 3
    zones = {r.onet_soc_code: r for r in views["bridge_occupation_job_zone"].collect()}
    assert zones["11-1011.00"].job_zone_label == "unknown"
    assert views["bridge_occupation_software"].count() == 2


def test_validation_of_the_views(views):
    found = gold_checks.validation(views)
    assert len(found) == 9
    for name in gold_checks.UNIQUE_KEYS:
        assert found[f"{name}_key"].count() == 0, name
    assert tuple(found["dim_occupation_nulls"].first()) == (0, 0)
    hits = found["fact_oews_measurement_lookups"].first()
    assert (hits.total_oews_rows, hits.rows_with_area_name) == (5, 4)
    matches = found["fact_occupation_projection_matches"].first()
    assert (matches.total_projection_rows, matches.unmatched_projection_rows) == (5, 0)
    coverage = [tuple(r) for r in found["bridge_coverage"].collect()]
    assert [r[0] for r in coverage] == sorted(r[0] for r in coverage)
    assert ("15-1252", "Software developers", 1, 1, 1, 1) in coverage
    assert ("53-7199", "Movers", 0, 0, 0, 0) in coverage


def test_board(views):
    view = board.projection_metrics(views["fact_occupation_projection"])
    total = board.counters(view).first()
    assert total.total_base_employment == 500500
    assert total.total_projected_employment == 850500
    assert total.total_annual_openings == 37000
    assert board.fastest_growing(view, 1).first().occupation_title == "Software developers"
    assert board.most_openings(view, 1).first().total_annual_openings == 15000
    assert board.highest_paying(view, 1).first().median_annual_wage == 239200.0
    assert board.details(view).count() == board.wage_and_growth(view).count() == 3
    assert board.facet_values(view).filter("facet = 'growth_direction'").count() == 3


def test_an_absent_required_column_is_reported_and_drops_nothing(spark, tmp_path):
    from source_files import write_tsv

    path = write_tsv(tmp_path / "f.txt", ["footnote_code"], [["1"], ["2"]])
    clean, found = survey_tables.FOOTNOTES.build(spark, path, "r")
    assert clean.count() == 2
    row = found.first()
    assert (row.rule_name, row.raw_value) == ("missing_required_column", "footnote_text")


def test_a_lost_column_changes_no_table(spark, tmp_path, paths):
    from source_files import write_tsv

    broken = dict(paths)
    broken["bls_employment_projections"] = write_tsv(
        tmp_path / "p.txt", ["title"], [["x"]], preamble=1
    )
    with pytest.raises(RuntimeError, match="soc_code_raw|occupation_title"):
        TableJob(spark).run(survey_tables.SPECS, broken, run_id="lost-column")
    assert spark.table(AUDIT_TABLE).filter("run_id = 'lost-column'").count() == 0


def test_a_failed_write_is_audited_and_stops_the_run(spark, paths):
    def spec(name):
        return TableSpec(
            name, "BLS", "f", required=("footnote_code",), key=("footnote_code",)
        )

    path = paths["bls_oews_footnotes"]
    names = ("failing_ok", "no such schema.t", "failing_never")
    issue_count = spark.table(ISSUE_TABLE).count()
    with pytest.raises(RuntimeError, match="run_id=failing"):
        TableJob(spark).run(
            [spec(n) for n in names], {n: path for n in names}, run_id="failing"
        )
    audit = {
        r.table_name: r
        for r in spark.table(AUDIT_TABLE).filter("run_id = 'failing'").collect()
    }
    assert set(audit) == set(names[:2])
    assert audit[names[0]].status == "success"
    failed = audit[names[1]]
    assert (failed.status, failed.row_count) == ("failed", None)
    assert "Exception: " in failed.error_message
    assert spark.table(ISSUE_TABLE).count() == issue_count


def _specs(*names):
    return [
        TableSpec(n, "BLS", "f", required=("footnote_code",), key=("footnote_code",))
        for n in names
    ]


def test_a_failed_run_changes_no_table_where_all_are_published_together(spark, tmp_path, paths):
    from source_files import write_tsv

    job = TableJob(spark, together=True)
    full, names = paths["bls_oews_footnotes"], ("together_a", "together_b")
    job.run(_specs(*names), dict.fromkeys(names, full), run_id="together-1")
    before = {n: spark.table(n).count() for n in names}
    empty = write_tsv(tmp_path / "e.txt", ["footnote_code", "footnote_text"], [])
    wrong = (*names, "no such schema.t")
    with pytest.raises(RuntimeError, match="together-2"):
        job.run(_specs(*wrong), dict.fromkeys(wrong, empty), run_id="together-2")
    assert {n: spark.table(n).count() for n in names} == before
    audit = spark.table(AUDIT_TABLE).filter("run_id = 'together-2'")
    assert sorted((r.table_name, r.status) for r in audit.collect()) == [
        ("no such schema.t", "failed"),
        ("together_a", "withdrawn"),
        ("together_b", "withdrawn"),
    ]
    with pytest.raises(ValueError, match="together"):
        TableJob(spark, format="delta", together=True)


def test_a_repeated_run_is_logged_once(spark, paths):
    name = "repeated_run"
    for _ in range(2):
        found = TableJob(spark).run(
            _specs(name), {name: paths["bls_oews_footnotes"]}, run_id="again"
        )
    logged = spark.table(ISSUE_TABLE).filter("run_id = 'again'").count()
    assert logged == found.issue_count
    assert spark.table(AUDIT_TABLE).filter("run_id = 'again'").count() == 1
