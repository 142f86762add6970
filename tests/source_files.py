"""Small source files in the layout of the real ones, each with the usual dirt."""

from __future__ import annotations

from pathlib import Path

Rows = list[list[str]]


def write_tsv(path: Path, header: list[str], rows: Rows, preamble: int = 0) -> str:
    path.parent.mkdir(parents=True, exist_ok=True)
    lines = [f"Preamble line {i}" for i in range(preamble)]
    lines += ["\t".join(line) for line in [header, *rows]]
    path.write_text("\n".join(lines) + "\n", encoding="utf-8")
    return str(path)


RATING_HEADER = [
    "O*NET-SOC Code", "Element ID", "Element Name", "Scale ID", "Data Value", "N",
    "Standard Error", "Lower CI Bound", "Upper CI Bound", "Recommend Suppress",
    "Not Relevant", "Date", "Domain Source",
]


def rating_rows() -> Rows:
    tail = ["8", "0.1", "3.1", "4.1", "N", "n/a", "08/2023", "Analyst"]
    return [
        ["15-1252.00", "2.A.1.a", "Reading", "IM", "4.12", *tail],
        ["15-1252.00", "2.A.1.b", "Listening", "IM", "3.88", *tail],
        ["15-1252.00", "2.A.1.c", "Writing", "IM", "3.88", *tail],
        ["15-1252.00", "2.A.1.a", "Reading", "LV", "4.50", *tail],
        # exact duplicate
        ["15-1252.00", "2.A.1.b", "Listening", "IM", "3.88", *tail],
        # conflicting duplicate
        ["11-1011.00", "2.A.1.a", "Reading", "IM", "4.00", *tail],
        ["11-1011.00", "2.A.1.a", "Reading", "IM", "4.25", *tail],
        # bad format, failed cast, null required value
        ["15-1252", "2.A.1.a", "Reading", "IM", "3.00", *tail],
        ["29-1141.00", "2.A.1.a", "Reading", "IM", "high", *tail],
        ["29-1141.00", "—", "Reading", "IM", "2.00", *tail],
    ]


def write_sources(root: Path) -> dict[str, str]:
    """All 24 sources; returns table name -> path."""
    paths: dict[str, str] = {}

    def put(name: str, file: str, header: list[str], rows: Rows, preamble: int = 0):
        paths[name] = write_tsv(root / file, header, rows, preamble)

    put(
        "bls_oews_observations", "oe_data.txt",
        ["series_id", "year", "period", "       value", "footnote_codes"],
        [
            ["S1 ", "2023", "A01", "  1234.5", ""],
            ["S1", "2024", "M03", "$1,300", "5"],
            ["S2", "2023", "S02", "77", ""],
            ["S2", "2023", "S02", "77", ""],
            ["S3", "2023", "A01", "10", ""],
            ["S3", "2023", "A01", "11", ""],
            ["S4", "2023", "Q01", "5", ""],
            ["S4", "20x3", "A01", "5", ""],
            ["S5", "2023", "A01", "-", "8"],
            ["S5", "2023", "A01", "*", "8"],
            ["N/A", "2023", "A01", "1", ""],
            ["S9", "2023", "A01", "9", ""],
        ],
    )
    put(
        "bls_oews_series", "oe_series.txt",
        ["series_id", "seasonal", "areatype_code", "area_code", "industry_code",
         "occupation_code", "datatype_code", "sector_code", "series_title",
         "footnote_codes", "begin_year", "begin_period", "end_year", "end_period"],
        [
            ["S1", "U", "N", "00", "000000", "151252", "01", "00", "Dev", "", "2020",
             "A01", "2024", "A01"],
            ["S2", "U", "S", "01", "000000", "111011", "04", "00", "Chief", "", "2020",
             "A01", "bad", "A01"],
            ["S3", "U", "N", "99", "999999", "12", "01", "00", "Short", "", "2020",
             "A01", "2024", "A01"],
            ["S4", "U", "N", "00", "000000", "151252", "01", "00", "Dev2", "", "2020",
             "A01", "2024", "A01"],
            ["S5", "U", "N", "00", "000000", "null", "01", "00", "None", "", "2020",
             "A01", "2024", "A01"],
        ],
    )
    put(
        "bls_oews_occupations", "oe_occupation.txt",
        ["occupation_code", "occupation_name", "occupation_description",
         "display_level", "selectable", "sort_sequence"],
        [
            ["151252", "Software Developers", "Build", "3", "T", "1"],
            ["150000", "Computer Occupations", "Group", "1", "T", "2"],
            ["111011", "Chief Executives", "Lead", "3", "T", "x"],
        ],
    )
    put(
        "bls_oews_areas", "oe_area.txt",
        ["state_code", "area_code", "areatype_code", "area_name"],
        [["00", "00", "N", "National"], ["01", "01", "S", "Alabama"],
         ["01", "01", "M", "Birmingham"], ["02", "02", "S", "NA"]],
    )
    put(
        "bls_oews_industries", "oe_industry.txt",
        ["industry_code", "industry_name", "display_level", "selectable",
         "sort_sequence"],
        [["000000", "All industries", "0", "T", "1"],
         ["000000", "All industries", "0", "T", "1"]],
    )
    put(
        "bls_oews_datatypes", "oe_datatype.txt",
        ["datatype_code", "datatype_name"],
        [["01", "Employment"], ["04", "Annual mean wage"], ["04", "Mean wage"]],
    )
    put(
        "bls_oews_footnotes", "oe_footnote.txt",
        ["footnote_code", "footnote_text"],
        [["5", "Above top code"], ["8", "–"]],
    )
    put(
        "bls_employment_projections", "projections.txt",
        ["2024 National Employment Matrix title", "2024 National Employment Matrix code",
         "Occupation type", "Employment, 2024", "Employment, 2034",
         "Employment change, numeric, 2024–34", "Employment change, percent, 2024–34",
         "Occupational openings, 2024–34 annual average",
         "Median annual wage, dollars, 2024[1]", "Typical education needed for entry",
         "Work experience in a related occupation",
         "Typical on-the-job training needed to attain competency in the occupation",
         "Employment distribution, percent, 2024",
         "Employment distribution, percent, 2034", "Percent self employed, 2024", ""],
        [
            ["Total, all occupations", "00-0000", "Summary", "1,000.4", "1,100.4",
             "100", "10", "50.5", "49,500", "—", "—", "—", "100", "100", "6", ""],
            ["Computer occupations", "15-0000", "Summary", "500", "600", "100", "20",
             "20", "105,000", "—", "—", "—", "50", "55", "3", ""],
            ["Software developers", "15-1252", "Line item", "300.5", "350.5", "50",
             "16.6", "15", "133,080", "Bachelor's degree", "None", "None", "30", "32",
             "2", ""],
            ["Chief executives", "11-1011", "Line item", "200", "190", "-10", "-5.0",
             "10", ">=$239,200", "Bachelor's degree", "5 years or more", "None", "20",
             "17", "20", ""],
            ["Registered nurses", "29-1141", "Line item", "abc", "310", "0", "0.0",
             "12", "< 93,600", "Master's degree", "None", "None", "30", "28", "1", ""],
            ["Odd code", "29-1141-99", "Line item", "1", "1", "0", "", "1", "≤10",
             "", "None", "None", "0", "0", "0", ""],
            ["Footnotes: none", "", "", "", "", "", "", "", "", "", "", "", "", "", "",
             ""],
            [" " for _ in range(16)],
        ],
        preamble=1,
    )
    put(
        "bls_national_employment_matrix", "matrix.txt",
        ["Occupation title", "Occupation code", "Occupation type", "Industry title",
         "Industry code", "Industry type", "2024 Employment", "2024 Percent of Industry",
         "2024 Percent of Occupation", "2034 Employment", "2034 Percent of Industry",
         "2034 Percent of Occupation", "Numeric Change, 2024-34",
         "Percent Change, 2024-34"],
        [
            ["Software developers", "15-1252", "Line item", "Software", "513200",
             "Line item", "10", "20%", "3", "12", "21", "4", "2", "20"],
            ["Software developers", "15-1252", "Line item", "Software", "513200",
             "Line item", "10", "20%", "3", "12", "21", "4", "2", "20"],
            ["Nobody", "x", "Line item", "Software", "513200", "Line item", "1", "1",
             "1", "1", "1", "1", "0", "0"],
        ],
    )
    put(
        "bls_onet_soc_crosswalk", "crosswalk.txt",
        ["Sort Order", "O*NET-SOC Code", "O*NET-SOC Title", "NEM Code", "NEM Title",
         "OOH Profile Code", "OOH Profile Title"],
        [
            ["1", "15-1252.00", "Software Developers", "15-1252", "Software developers",
             "1", "Developers"],
            ["two", "11-1011.00", "Chief Executives", "11-1011", "Chief executives",
             "2", "Executives"],
            ["3", "11-1011", "Chief Executives", "111011", "Chief executives", "2",
             "Executives"],
        ],
        preamble=4,
    )
    put(
        "bls_nem_occupational_coverage", "coverage.txt",
        ["Sort order", "National Employment Matrix code",
         "National Employment Matrix title", "Occupation type", "Level"],
        [["1", "15-1252", "Software developers", "Line item", "4"],
         ["2", "15-1252", "Software developers (again)", "Line item", "4"],
         ["3", "15-0000", "Computer occupations", "Summary", "one"]],
        preamble=3,
    )
    put(
        "onet_occupations", "Occupation Data.txt",
        ["O*NET-SOC Code", "Title", "Description"],
        [["15-1252.00", "Software Developers", "Build software"],
         ["15-1252.01", "Game Developers", "Build games"],
         ["11-1011.00", "Chief Executives", "Lead"],
         ["53-7199.00", "Movers", "Move"],
         ["99-99", "Broken", "Bad code"]],
    )
    put(
        "onet_education_categories", "Education Categories.txt",
        ["Element ID", "Element Name", "Scale ID", "Category", "Category Description"],
        [["2.D.1", "Required Level", "RL", "1", "Less than high school"],
         ["2.D.1", "Required Level", "RL", "6", "Bachelor's degree"],
         ["2.D.1", "Required Level", "RL", "six", "Bad"]],
    )
    categories = [
        ["15-1252.00", "2.D.1", "Required Level", "RL", "6", "70.5"],
        ["15-1252.00", "2.D.1", "Required Level", "RL", "1", "70.5"],
        ["15-1252.00", "2.D.1", "Required Level", "RL", "8", "10"],
        ["11-1011.00", "2.D.1", "Required Level", "RL", "6", "55"],
        ["11-1011.00", "2.D.1", "Required Level", "RL", "6", "56"],
        ["11-1011.00", "2.D.1", "Required Level", "RL", "1.5", "5"],
    ]
    tail = ["25", "1.1", "60", "80", "N", "13/2023", "Incumbent"]
    for name, file in (
        ("onet_education", "Education.txt"),
        ("onet_training_experience", "Training and Experience.txt"),
    ):
        put(
            name, file,
            ["O*NET-SOC Code", "Element ID", "Element Name", "Scale ID", "Category",
             "Data Value", "N", "Standard Error", "Lower CI Bound", "Upper CI Bound",
             "Recommend Suppress", "Date", "Domain Source"],
            [c + tail for c in categories],
        )
    for name, file in (
        ("onet_essential_skills", "Essential Skills.txt"),
        ("onet_transferable_skills", "Transferable Skills.txt"),
        ("onet_knowledge", "Knowledge.txt"),
        ("onet_abilities", "Abilities.txt"),
        ("onet_work_activities", "Work Activities.txt"),
    ):
        put(name, file, RATING_HEADER, rating_rows())
    put(
        "onet_software_skills", "Software Skills.txt",
        ["O*NET-SOC Code", "Workplace Example", "Element ID", "Element Name",
         "Hot Technology", "In Demand"],
        [["15-1252.00", "Git", "5.A", "Version control", "Y", "Y"],
         ["15-1252.00", "Python", "5.B", "Language", "Yes", "maybe"],
         ["15-1252.00", "Git", "5.A", "Version control", "Y", "Y"],
         ["11-1011.00", "NULL", "5.A", "Version control", "N", "N"]],
    )
    put(
        "onet_task_statements", "Task Statements.txt",
        ["O*NET-SOC Code", "Task ID", "Task", "Task Type", "Incumbents Responding",
         "Date", "Domain Source"],
        [["15-1252.00", "21666", "Write code", "Core", "88", "08/2023", "Incumbent"],
         ["15-1252.00", "x", "Test code", "Core", "n/a", "08/2023", "Incumbent"]],
    )
    put(
        "onet_job_zones", "Job Zones.txt",
        ["O*NET-SOC Code", "Job Zone", "Date", "Domain Source"],
        [["15-1252.00", "4", "08/2023", "Analyst"],
         ["11-1011.00", "7", "08/2023", "Analyst"],
         ["53-7199.00", "2.5", "08/2023", "Analyst"]],
    )
    put(
        "onet_related_occupations", "Related Occupations.txt",
        ["O*NET-SOC Code", "Related O*NET-SOC Code", "Relatedness Tier", "Index"],
        [["15-1252.00", "15-1252.01", "Primary-Short", "1"],
         ["15-1252.00", "11-1011", "Primary-Long", "2"],
         ["11-1011.00", "15-1252.00", "Supplemental", "three"]],
    )
    return paths
