from __future__ import annotations

import random
from pathlib import Path

import pytest

import corpus_pipeline
from strata.llm import balancing, decontamination, divergence
from strata.llm.queries import QUERIES
from tests.llm.test_minhash import brute
from tests.llm.test_sequences import encode_plainly


@pytest.fixture()
def folder(spark, tmp_path):
    """A small table folder: prose, copies, junk and a leaked item."""
    rnd = random.Random(12)
    vocabulary = ["the", "of", "and", "to", "in"] * 8 + [f"term{i}" for i in range(300)]

    def prose(n):
        return " ".join(rnd.choices(vocabulary, k=n))

    item = prose(30)
    rows = [(i, prose(rnd.randrange(60, 160)), "en", f"s{i % 3}") for i in range(60)]
    rows += [(100 + i, rows[i][1], "en", "s1") for i in range(8)]
    rows += [(200, rows[9][1] + " end", "en", "s0"), (201, "###% ".join(prose(90).split()), "en", "s2")]
    rows += [(300, f"{prose(40)} {item} {prose(40)}", "en", "s0"), (301, None, "en", "s0")]
    rows += [(302, "short text", None, None)]
    spark.createDataFrame(
        [(*r, len(r[1] or "")) for r in rows],
        "doc_id long, text string, lang string, source string, n_chars long",
    ).write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(
        str(tmp_path / "benchmark.parquet")
    )
    return str(tmp_path), rows, item


def test_pipeline_matches_plain_steps(spark, folder):
    path, rows, item = folder
    got = corpus_pipeline.run(spark, path).orderBy("start").collect()
    docs = spark.read.parquet(f"{path}/documents.parquet")
    good = {r["doc_id"] for r in divergence.judge(docs).filter("kept").collect()}
    assert good == {i for i, *_ in rows} - {201, 301, 302}
    left = [(i, t) for i, t, *_ in rows if i in good]
    left = [(i, t) for i, t in left if brute(left)[i][1] == i]
    assert len(left) == len(good) - 9
    left = [(i, t) for i, t in left if item not in t]
    assert 300 not in dict(left)
    kept = docs.filter(docs["doc_id"].isin([i for i, _ in left]))
    copies = {r["doc_id"]: r["copies"] for r in balancing.mix_sizes(kept).collect()}
    order = [i for i in sorted(copies) for _ in range(copies[i])]
    assert [r["doc_id"] for r in got] == order
    size = dict(zip([i for i, _ in left], map(len, encode_plainly([t for _, t in left]))))
    assert [r["n_tokens"] for r in got] == [size[i] + 1 for i in order]
    assert [r["start"] for r in got] == [
        sum(size[i] + 1 for i in order[:n]) for n in range(len(order))
    ]


def test_stages_return_the_columns_of_documents(spark, folder):
    path, *_ = folder
    docs = spark.read.parquet(f"{path}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, path).columns == docs.columns
        assert stage(spark, docs.limit(0), path).count() == 0


def test_queries_run_on_whole_tables(spark):
    path = "/root/testdata/sf0.001"
    if not Path(path).exists():
        pytest.skip("no test tables here")
    rows = spark.read.parquet(f"{path}/documents.parquet").count()
    pages = spark.read.parquet(f"{path}/pages.parquet").count()
    for name, query in QUERIES.items():
        found = query(spark, path).count()
        if name.startswith(("op6_", "op11_", "op12_")):
            assert found > 0
        else:
            assert found == (pages if name.startswith("op2_") else rows), name
    assert decontamination.Settings().max_percent == 20
