from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F
from source_files import write_tsv

from strata.sources import files, manifest, series, tables
from strata.sources.manifest import ExpectedFile


def test_ragged_and_quoted_lines(spark, tmp_path, rows):
    path = tmp_path / "t.txt"
    path.write_text('a\tb\tc\n1\t2\n1\t2\t3\t4\n"x\ty"\t\t z \n', encoding="utf-8")
    df = files.read_delimited(spark, str(path))
    assert {t for _, t in df.dtypes} == {"string"}
    assert rows(df) == [("1", "2", "3"), ("1", "2", None), ("x\ty", None, " z ")]


def test_header_offset(spark, tmp_path, rows):
    path = write_tsv(
        tmp_path / "t.txt",
        ["Code", "", "Name", "Empty", "Code"],
        [["1", "", "x", " ", "7"], ["", "", "  ", "", ""], ["2", "", "", "", "8"]],
        preamble=3,
    )
    df = files.read_with_header_offset(spark, path, 3)
    assert df.columns == ["Code", "Name", "Code.1"]
    assert rows(df) == [("1", "x", "7"), ("2", None, "8")]


def test_header_offset_keeps_later_lines_equal_to_the_header(spark, tmp_path, rows):
    path = write_tsv(tmp_path / "t.txt", ["a", "b"], [["a", "b"], ["1", "2"]])
    assert rows(files.read_with_header_offset(spark, path, 0)) == [("1", "2"), ("a", "b")]


def test_header_offset_of_a_file_in_many_blocks(spark, tmp_path):
    data = [[str(i), "x" * 50] for i in range(2000)]
    path = write_tsv(tmp_path / "t.txt", ["id", "pad"], data, preamble=2)
    limit = "spark.sql.files.maxPartitionBytes"
    before = spark.conf.get(limit)
    spark.conf.set(limit, "16k")
    try:
        df = files.read_with_header_offset(spark, path, 2, line_breaks=False)
        assert df.rdd.getNumPartitions() > 4
        assert sorted(int(r.id) for r in df.collect()) == list(range(2000))
    finally:
        spark.conf.set(limit, before)


def test_header_offset_of_several_files(spark, tmp_path):
    for part in range(5):
        data = [[str(part * 1000 + i), "x" * part] for i in range(1000)]
        write_tsv(tmp_path / "d" / f"{part}.txt", ["id", "pad"], data, preamble=2)
    limit = "spark.sql.files.maxPartitionBytes"
    before = spark.conf.get(limit)
    spark.conf.set(limit, "7k")
    try:
        df = files.read_with_header_offset(spark, str(tmp_path / "d"), 2)
        assert sorted(int(r.id) for r in df.collect()) == list(range(5000))
    finally:
        spark.conf.set(limit, before)


def test_each_file_is_read_by_its_own_header(spark, tmp_path, rows):
    write_tsv(tmp_path / "d" / "a.txt", ["id", "name"], [["1", "x"]], preamble=1)
    write_tsv(tmp_path / "d" / "b.txt", ["name", "id"], [["y", "2"]], preamble=1)
    df = files.read_with_header_offset(spark, str(tmp_path / "d"), 1)
    assert rows(df, "id", "name") == [("1", "x"), ("2", "y")]


def test_files_with_other_columns_are_named(spark, tmp_path):
    write_tsv(tmp_path / "d" / "a.txt", ["id", "name"], [["1", "x"]], preamble=1)
    write_tsv(tmp_path / "d" / "b.txt", ["id", "title"], [["2", "y"]], preamble=1)
    with pytest.raises(ValueError, match="b.txt has the columns"):
        files.read_with_header_offset(spark, str(tmp_path / "d"), 1)


def test_a_failed_overwrite_leaves_the_table(spark):
    name = "kept_table"
    tables.write_table(spark.range(5).toDF("a"), name)
    bad = spark.range(3).select(F.raise_error(F.lit("no")).cast("long").alias("a"))
    with pytest.raises(Exception, match="no"):
        tables.write_table(bad, name)
    assert spark.table(name).count() == 5
    assert tables.write_table(spark.range(7).select(F.col("id").alias("b")), name) == 7
    assert spark.table(name).columns == ["b"] and spark.table(name).count() == 7
    assert tables.write_table(spark.range(2).select(F.col("id").alias("b")), name, "append") == 2
    assert spark.table(name).count() == 9


def test_owned_stages_are_gone_at_the_end(spark):
    with tables.owned_stages(spark) as folder:
        staged = tables.stage(spark.range(4).toDF("a"), "x")
        assert staged.count() == 4 and len(tables.folders(spark, folder)) == 1
    assert tables.folders(spark, folder) == []
    assert not tables.folders(spark, tables.shared_folder(spark) + "/no-such-folder")


def test_header_offset_without_rows_is_an_error(spark, tmp_path):
    short = write_tsv(tmp_path / "short.txt", ["a"], [])
    with pytest.raises(ValueError, match="no line|no value"):
        files.read_with_header_offset(spark, short, 4)
    with pytest.raises(ValueError, match="no line|no value"):
        files.read_with_header_offset(spark, short, 0)


EXPECTED = [
    ExpectedFile("S", "g", "here.txt", "present", "http://example.org/here"),
    ExpectedFile("S", "g", "empty.txt"),
    ExpectedFile("S", "g", "gone.txt", required=False),
]


@pytest.fixture()
def raw_folder(tmp_path):
    (tmp_path / "g").mkdir()
    (tmp_path / "g" / "here.txt").write_text("abc")
    (tmp_path / "g" / "empty.txt").write_text("")
    return str(tmp_path)


def test_manifest(spark, raw_folder):
    found = {r.file_name: r for r in manifest.manifest(spark, EXPECTED, raw_folder).collect()}
    assert (found["here.txt"].download_status, found["here.txt"].bytes_written) == (
        "success", 3,
    )
    assert found["here.txt"].error_message is None
    for name in ("empty.txt", "gone.txt"):
        assert found[name].download_status == "failed"
        assert found[name].error_message == "File is missing or empty"


def test_manifest_reads_no_file_content(spark, raw_folder):
    plan = manifest.manifest(spark, EXPECTED, raw_folder)._jdf.queryExecution()
    assert "content" not in plan.executedPlan().toString()


def test_only_required_files_stop_a_run(spark, raw_folder):
    listed = manifest.manifest(spark, EXPECTED, raw_folder)
    assert [r.file_name for r in manifest.missing_required(listed).collect()] == [
        "empty.txt"
    ]
    with pytest.raises(RuntimeError, match="empty.txt"):
        manifest.require_sources(listed)
    manifest.require_sources(listed.filter("file_name <> 'empty.txt'"))


def test_archive_members(spark, raw_folder):
    members = manifest.archive_members(spark, raw_folder, "S", "http://x", "30.3")
    assert {r.saved_file_name for r in members.collect()} == {"here.txt"}
    total = manifest.archive_summary(members).first()
    assert (total.file_count, total.bytes_written, total.database_version) == (
        1, 3, "30.3",
    )


def response(status, points):
    data = [
        {"year": y, "period": p, "periodName": "n", "value": v, "footnotes": f}
        for y, p, v, f in points
    ]
    return json.dumps(
        {"status": status, "Results": {"series": [{"seriesID": "S1", "data": data}]}}
    )


def test_responses_are_flattened(spark, rows):
    points = [("2023", "M01", "1", [{"code": "A", "text": "t"}, {}]), ("2023", "M02", "2", [])]
    documents = spark.createDataFrame(
        [
            (response("REQUEST_SUCCEEDED", points),),
            (response("REQUEST_NOT_PROCESSED", points),),
            ("not json",),
        ],
        "value string",
    )
    assert rows(series.flatten_responses(documents)) == [
        ("S1", "2023", "M01", "n", "1", "A"),
        ("S1", "2023", "M02", "n", "2", ""),
    ]


def test_latest_per_series(spark, rows):
    df = spark.createDataFrame(
        [("a", 2023, "M02", 1), ("a", 2024, "M01", 2), ("b", 2020, "A01", 3)],
        "s string, year int, period string, v int",
    )
    newest = series.latest(df, ["s"], ["year", "period"])
    assert newest.columns == df.columns
    assert rows(newest) == [("a", 2024, "M01", 2), ("b", 2020, "A01", 3)]


def test_writes_count_rows_without_reading_back(spark, rows):
    df = spark.createDataFrame([(1, "x"), (2, "y")], "n int, p string")
    assert tables.write_table(df, "written", partition_by=["p"]) == 2
    assert tables.write_table(df.filter("n = 1"), "written", "append", ["p"]) == 1
    assert tables.count_rows(spark, "written") == 3
    wider = df.withColumn("more", F.lit(1))
    assert tables.write_table(wider, "written") == 2
    assert spark.table("written").columns == ["n", "p", "more"]


def test_stage_is_under_the_configured_folder(spark):
    staged = tables.stage(spark.range(5), "numbers")
    folder = spark.conf.get("spark.checkpoint.dir")
    assert staged.count() == 5
    assert all(folder in f for f in staged.inputFiles())


def _state(spark, name):
    described = tables._described(spark, name)
    listed = {r["key"]: r["value"] for r in spark.sql(f"SHOW TBLPROPERTIES {name}").collect()}
    return described.get("Comment"), listed.get("team"), described["Location"]


@pytest.mark.parametrize("partition_by", [[], ["p"]])
def test_an_overwrite_leaves_a_table_to_read_at_any_time(spark, partition_by):
    name = "kept_" + "_".join(["by", *partition_by])
    df = spark.createDataFrame([(1, "a"), (2, "b")], "n int, p string")
    tables.write_table(df, name, partition_by=partition_by)
    spark.sql(f"COMMENT ON TABLE {name} IS 'it''s kept'")
    spark.sql(f"ALTER TABLE {name} SET TBLPROPERTIES ('team' = 'us')")
    before = _state(spark, name)
    version = tables.write_version(df.limit(1), name, partition_by)
    assert version.rows == 1 and spark.table(name).count() == 2
    version.publish()
    after = _state(spark, name)
    assert spark.table(name).count() == 1
    assert after[:2] == before[:2] == ("it's kept", "us") and after[2] != before[2]
    version.withdraw()
    assert spark.table(name).count() == 2 and _state(spark, name) == before


def test_columns_added_at_the_end_and_other_columns(spark):
    df = spark.range(3).select(F.col("id").alias("a"))
    tables.write_table(df, "grown")
    spark.sql("COMMENT ON TABLE grown IS 'c'")
    spark.sql("ALTER TABLE grown SET TBLPROPERTIES ('team' = 'us')")
    wider = tables.write_version(df.withColumn("b", F.lit("x")), "grown")
    wider.publish()
    assert spark.table("grown").columns == ["a", "b"] and _state(spark, "grown")[:2] == ("c", "us")
    other = tables.write_version(df.select(F.lit(1.5).alias("z")), "grown")
    other.publish()
    assert spark.table("grown").columns == ["z"] and _state(spark, "grown")[:2] == ("c", "us")
    other.withdraw()
    assert spark.table("grown").columns == ["a", "b"] and spark.table("grown").count() == 3
    assert _state(spark, "grown")[:2] == ("c", "us")


def test_all_versions_are_published_or_none(spark):
    df = spark.range(2).toDF("a")
    for name in ("first_of_two", "second_of_two"):
        tables.write_table(df, name)
    versions = [
        tables.write_version(df.limit(0), n) for n in ("first_of_two", "second_of_two", "third")
    ]
    versions[1].publish = lambda: 1 / 0
    with pytest.raises(ZeroDivisionError):
        tables.publish_together(versions)
    assert spark.table("first_of_two").count() == spark.table("second_of_two").count() == 2
    assert not spark.catalog.tableExists("third")


def test_a_repeated_run_replaces_its_rows_only(spark):
    def rows(*runs):
        return spark.createDataFrame([(r, 1) for r in runs], "run_id string, n int")

    assert tables.replace_run(rows("a", "a"), "run_log", "a") == 2
    assert tables.replace_run(rows("b/1 %"), "run_log", "b/1 %") == 1
    assert tables.replace_run(rows("a", "a", "a"), "run_log", "a") == 3
    counts = {r["run_id"]: r["count"] for r in spark.table("run_log").groupBy("run_id").count().collect()}
    assert counts == {"a": 3, "b/1 %": 1}
    assert tables.replace_run(rows("a").limit(0), "run_log", "a") == 0
    assert [r["run_id"] for r in spark.table("run_log").collect()] == ["b/1 %"]


def test_cells_with_line_breaks(spark, rows, tmp_path):
    texts = [
        'Title\n\n"a\n\nb"\tx\nid\t"na\nme"\tv\n1\t"two\n\nlines"\t5"\n\t\t\n2\tplain\t'
        '"q ""x"" y"\n\n3\tb\n',
        'T2\n\nz\nv\tid\t"na\nme"\n9\t7\t"tab\there"\n',
        '\n\n\nid\tv\t"na\nme"\n',
    ]
    for i, text in enumerate(texts):
        (tmp_path / f"{i}.txt").write_text(text)
    df = files.read_with_header_offset(spark, str(tmp_path), 3)
    assert df.columns == ["id", "na\nme", "v"]
    assert rows(df) == sorted(
        [
            ("1", "two\n\nlines", '5"'),
            ("2", "plain", 'q "x" y'),
            ("3", "b", None),
            ("7", "tab\there", "9"),
        ],
        key=repr,
    )


def test_sheets_of_one_column(spark, rows, tmp_path):
    (tmp_path / "one.txt").write_text('head\nname\n"a\nb"\n"say ""x"""\nplain\n')
    df = files.read_with_header_offset(spark, str(tmp_path), 1)
    assert rows(df) == [("a\nb",), ("plain",), ('say "x"',)]


def test_both_ways_of_reading_agree_where_no_cell_holds_a_break(spark, rows, tmp_path):
    body = "\n".join(f"{i}\t{'x' * (i % 5)}\t{i % 7 or ''}" for i in range(300))
    (tmp_path / "s.txt").write_text(f"T\n\nid\ta\tb\n{body}\n")
    whole, split = (
        files.read_with_header_offset(spark, str(tmp_path), 2, line_breaks=b)
        for b in (True, False)
    )
    assert rows(whole) == rows(split) and whole.columns == split.columns


def test_malformed_rows_are_kept_with_their_text(spark, rows, tmp_path):
    (tmp_path / "r.txt").write_text("a\tb\n1\t2\n3\n4\t5\t6\n")
    df = files.read_delimited(spark, str(tmp_path), malformed="text")
    assert rows(df) == sorted(
        [("1", "2", None), ("3", None, "3"), ("4", "5", "4\t5\t6")], key=repr
    )
    assert rows(df.select("b", "text")) == sorted(
        [("2", None), (None, "3"), ("5", "4\t5\t6")], key=repr
    )
