from __future__ import annotations

import hashlib
import re
import zlib

import numpy as np
import pandas as pd
import pyarrow as pa
import pytest

from strata.llm import byte_cnn, credentials, divergence, html_text, toxicity
from strata.llm.buffers import utf8
from strata.llm.labelled import remainder, sample
from pyspark.sql import functions as F


# HTML


PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style>
<script>var x="</p>";</script></head><body><nav><ul><li><a href=/a>Menu</a></ul></nav>
<div class="ad">Buy now</div><article><h1>Big &amp; small</h1><p>First   paragraph<br>of
text.<p>Second &lt;one&gt; <b>bold</b>.<script>no()</script><aside>box</aside>
<ul><li>one<li>two</ul></article><div id="comments"><p>Nice post</p></div>
<footer>&copy; us</footer></body>"""


def test_article_without_its_surroundings():
    assert html_text.main_text(PAGE) == (
        "Big & small\nFirst paragraph of text.\nSecond <one> bold.\none\ntwo"
    )


def test_unmarked_page_is_selected_by_ratio():
    body = "".join(f"<p>{'word ' * 40}number {i}.</p>" for i in range(5))
    links = "".join(f"<li><a href=/{i}>Link {i}</a></li>" for i in range(30))
    text = html_text.main_text(f"<body><ul>{links}</ul><div>{body}</div><ul>{links}</ul>")
    assert text.count("\n") == 4 and "Link" not in text and "number 4." in text


@pytest.mark.parametrize("html", [None, "", "<p>", "<script>x</script>", "</div></p>"])
def test_pages_without_text(html):
    assert html_text.main_text(html) == ""


def test_plain_text_and_long_page():
    assert html_text.main_text("no tags  here") == "no tags here"
    long = "<article>" + "<p>some words of text</p>" * 20_000
    assert html_text.main_text(long).count("\n") == 19_999


def test_extract_on_frames(spark):
    rows = [(1, "u", PAGE, "x"), (1, "u", PAGE, "y"), (2, None, None, "z"), (None, "v", "<p>a", "")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, text string")
    got = html_text.extract(pages).collect()
    assert sorted((r["page_id"] or 0, len(r["text"])) for r in got)[0] == (0, 1)
    assert len(got) == 4
    assert html_text.extract(pages.limit(0)).collect() == []


#: Pages whose names hold words of noise, and what a reader takes for their main text.
PROSE = [f"Paragraph {i} of the report tells what was found in the year." for i in range(6)]
NAMED_PAGES = [
    (f'<body><nav>x</nav><article class="post category-social tag-login"><h1>Title</h1><p>{PROSE[0]}</p></article>'
     '<div class="share-buttons">Tell it</div>', ["Title", PROSE[0]]),
    (f'<article><h2 id="social-impact">Social impact</h2><p>{PROSE[0]}</p><section id="related-work">'
     f'<h2>Related work</h2><p>{PROSE[1]}</p></section><section id="login"><p>{PROSE[2]}</p></section>'
     '<div class="ad">Buy</div><div class="related-posts">More</div><section class="comments-area">Nice</section>'
     f'<div class="copyright-law"><p>{PROSE[3]}</p></div></article>',
     ["Social impact", PROSE[0], "Related work", *PROSE[1:4]]),
    (f'<main id="consent"><h3 class="share">Share of wind</h3><p>{PROSE[0]}</p><h2 id="search">Search</h2>'
     f'<section id="notice"><p>{PROSE[1]}</p></section><div id="comments">Nice</div></main>',
     ["Share of wind", PROSE[0], "Search", PROSE[1]]),
    (f'<body><div class="post category-social"><p>{PROSE[0]}</p><p>{PROSE[1]}</p></div>'
     '<div class="social-share">Tell it</div><div id="site-footer">us</div><div class="relatedPosts">More</div>',
     PROSE[:2]),
]


def text_recall(pages):
    lines = [(line, got) for html, want in pages for got in [html_text.main_text(html).split("\n")] for line in want]
    return sum(line in got for line, got in lines) / len(lines)


def test_words_of_names_do_not_drop_content():
    assert text_recall(NAMED_PAGES) == 1.0
    for html, want in NAMED_PAGES:
        assert html_text.main_text(html) == "\n".join(want)


LONG = "".join(f"<p>{'word ' * 30}number {i}.</p>" for i in range(20))
CLOSING = " ".join(PROSE)
ROWS = "".join(f"<tr><td><b>{i}</b></td><td><i>r{i}</i></td></tr>" for i in range(12))


@pytest.mark.parametrize(
    "page",
    [
        f"<body><article>{LONG}</article><article><p>{CLOSING}</p></article></body>",
        f"<body><div>{LONG}<table>{ROWS}</table><p>{CLOSING}</p></div></body>",
        f"<body><div>{LONG}</div><article><p>{CLOSING}</p></article></body>",
    ],
)
def test_small_regions_and_unmarked_bodies_stay(page):
    got = html_text.main_text(page).split("\n")
    assert CLOSING in got and sum("number" in line for line in got) == 20
    assert ("r7" in got) == ("<table>" in page)


PARAGRAPH = "<p>" + "A long paragraph of the article, with many words in it. " * 4 + "</p>"


def test_a_form_around_the_page_is_a_container():
    fields = '<input type="hidden" name="state" value="x"><input name="q"><button>Go</button>'
    page = f"<body><form action='.'>{fields}{PARAGRAPH * 4}<p>Short end.</p></form></body>"
    assert html_text.main_text(page).count("\n") == 4
    assert html_text.main_text(page).endswith("Short end.")
    asked = "<form><p>Subscribe to our letter</p><input><button>Send</button></form>"
    assert "Subscribe" not in html_text.main_text(f"<article>{PARAGRAPH}{asked}</article>{asked}")
    assert html_text.main_text(f"<body><p>Hi there</p>{asked}</body>") == "Hi there"
    assert html_text.main_text(f"<body>{asked}</body>") == ""


@pytest.mark.parametrize(
    "name", ["comment-body", "comment", "comment-text-17", "comments_area", "commentBody"]
)
def test_names_that_start_with_comment_are_comments(name):
    said = f'<div class="{name}"><p>I liked this one very much, thank you.</p></div>'
    for page in (f"<article>{PARAGRAPH}{said}</article>", f"<body>{PARAGRAPH * 3}{said}</body>"):
        assert "liked" not in html_text.main_text(page)
    kept = f'<div class="comments-open">{PARAGRAPH}</div>'
    assert html_text.main_text(kept) and html_text.main_text(f"<article>{kept}</article>")
    reply = f'<article>{PARAGRAPH}</article><article class="comment">{PARAGRAPH.replace("A", "My")}</article>'
    assert "My long" not in html_text.main_text(reply)


def test_short_lines_at_the_end_of_a_container_stay():
    short = "".join(f"<p>Step {i}</p>" for i in range(8))
    assert html_text.main_text(f"<body>{PARAGRAPH * 6}{short}</body>").count("\n") == 13
    menu = '<div><a href="/">Home</a> <a href="/a">About</a></div>'
    page = f"<body>{menu}<div><h2>Why</h2>{PARAGRAPH * 5}<p>two</p><p>The end.</p></div>{menu}</body>"
    text = html_text.main_text(page)
    assert text.startswith("Why\n") and text.endswith("two\nThe end.") and "Home" not in text


def test_little_unmarked_text_beside_an_article_is_left_out():
    page = f"<body><div><p>Read us daily, at any place.</p></div><article>{LONG}</article>"
    assert html_text.main_text(page).count("\n") == 19


# Quality rules


def base_by_hand(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    windows = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    inside = {
        i + k for i, w in enumerate(windows) if windows.count(w) > 1 for k in range(5)
    }
    lines = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    joined = "".join(words)
    failed = len(words) < 10 or 100 * len(inside) > 20 * len(words)
    return (
        len(words),
        len(joined),
        len(re.findall(r"[#*$%&|<>]", joined)),
        len(lines) - len(set(lines)),
        len(inside),
        failed,
    )


def quality_rows():
    import random

    rnd = random.Random(2)
    vocabulary = ["the", "of", "and", "to", "in"] * 6 + [f"word{i}x" for i in range(200)]

    def prose(n):
        return " ".join(rnd.choices(vocabulary, k=n))

    rows = [(i, prose(rnd.randrange(60, 200)), "en") for i in range(60)]
    rows += [(60, "#$% ".join(prose(100).split()), "en"), (61, prose(100).upper() + "!!", "en")]
    rows += [(62, "a b c d e f " * 30, "en"), (63, "one\ntwo\none\n\n \none", "en")]
    rows += [(64, None, "en"), (65, "", None), (66, prose(80), None), (67, "x y é ñ 日本", "xx")]
    return rows


def test_base_counts_and_verdicts(spark):
    rows = quality_rows()
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    got = {r["doc_id"]: r for r in divergence.judge(docs).collect()}
    assert len(got) == len(rows)
    for i, text, _ in rows:
        r = got[i]
        assert tuple(r[c] for c in divergence.RESULT[:-1]) == base_by_hand(text), i
    assert all(got[i]["kept"] for i in range(60))
    assert not any(got[i]["kept"] for i in (60, 61, 62, 63, 64, 65))
    # A language of one document has no reference to differ from.
    assert got[66]["kept"] and got[66]["class_distance"] is None


def test_keep_good_takes_any_columns(spark):
    rows = [(*r, 1, "k") for r in quality_rows()]
    docs = spark.createDataFrame(
        rows, "doc_id long, text string, lang string, n_words int, kept string"
    )
    left = divergence.keep_good(docs)
    assert left.columns == docs.columns
    assert sorted(r["doc_id"] for r in left.collect()) == [*range(60), 66]
    assert divergence.keep_good(docs.limit(0)).collect() == []
    assert divergence.judge(docs.limit(0)).collect() == []


def test_common_words_are_counted_by_array_functions(spark):
    data = [
        (["İab", "THE", "the", "x", "AΣ", "i̇ab"], ["the", "aς", "i̇ab"], [2, 1, 2, 1]),
        ([], ["the"], [0, 0]),
        (["a", "A"], [], [2]),
        (["a"], None, None),
    ]
    df = spark.createDataFrame(data, "w array<string>, c array<string>, n array<int>")
    counts = divergence._word_counts(F.col("w"), F.col("c"))
    assert [r[0] for r in df.select(counts.eqNullSafe(F.col("n"))).collect()] == [True] * 4
    # No lookup of each word among the common ones.
    plan = df.select(counts)._jdf.queryExecution().analyzed().toString()
    assert "array_remove" in plan and "array_contains" not in plan


def test_distance_is_symmetric_and_bounded(spark):
    row = spark.sql("select array(1D,0D) a, array(0D,1D) b, array(0.5D,0.5D) c").select(
        divergence.js_distance(F.col("a"), F.col("b")).alias("far"),
        divergence.js_distance(F.col("a"), F.col("c")).alias("x"),
        divergence.js_distance(F.col("c"), F.col("a")).alias("y"),
        divergence.js_distance(F.col("c"), F.col("c")).alias("same"),
    ).first()
    assert row["far"] == pytest.approx(1) and row["x"] == row["y"] and row["same"] == 0


# Secrets


def test_base_spans_follow_their_patterns():
    text = 'Token = "abcdefgh1" é password: short AKIAABCDEFGHIJKL ' + "f" * 33
    base, spans = credentials.spans_of(text)
    assert [str(s) for s in base] == [
        "assign:0:18",
        "access:38:54",
        f"hex:55:{55 + 33}",
    ]
    assert base == spans[: len(base)] or set(base) <= set(spans)


def test_short_values_are_consumed_and_dropped():
    assert credentials.base_spans("token=token:abcdefgh1234") == []
    # Only ASCII letters count as the other case.
    assert credentials.base_spans("ſecret=abcdefgh12") == []


def test_weak_parts_need_partners():
    value = "q8Zk2Lw9Xy4Vb7Nm1Tr6"
    alone = f"x {value} and https://db.example.com/path"
    assert credentials.spans_of(alone)[1] == []
    together = f"client_id: svc-account\n{value}\nhttps://db.example.com/path"
    kinds = [s.kind for s in credentials.spans_of(together)[1]]
    assert kinds == ["identifier", "secret", "endpoint"]
    apart = f"client_id: svc-account\n\n{value}"
    assert credentials.spans_of(apart)[1] == []
    far = f"client_id: svc-account {'word ' * 200}{value}"
    assert credentials.spans_of(far)[1] == []
    beside_base = f"AKIAABCDEFGHIJKL {value}"
    assert [s.kind for s in credentials.spans_of(beside_base)[1]] == ["access", "secret"]


def test_long_parts_are_matched_whole():
    value = "q8Zk2Lw9Xy4Vb7Nm1Tr6" * 30
    client = "123456789012-" + "xb3d" * 16 + ".apps.example.com"
    url = "https://store.example.com/file?" + "part=of-it&" * 30 + "X-Sig=q8Zk2Lw9Xy4Vb7Nm1Tr6%2F9"
    text = f"client_id: {client}\n{value}\n{url}"
    spans = credentials.spans_of(text)[1]
    assert [(s.kind, text[s.start : s.end]) for s in spans] == [
        ("identifier", f"client_id: {client}"), ("secret", value), ("endpoint", url)
    ]
    signed = f"client_id: svc-account\n{url}"
    assert [s.kind for s in credentials.spans_of(signed)[1]] == ["identifier", "endpoint"]
    token = f"client_id: svc-account\n{url}&token=abcdefgh1234%2Fxyz"
    spans = credentials.spans_of(token)[1]
    assert [s.kind for s in spans] == ["identifier", "endpoint", "assign"]
    assert spans[1].end == len(token)


def test_scan_on_frames(spark):
    rows = [(1, "token=abcdefgh12", "a"), (1, "token=abcdefgh12", "a"), (2, None, "b"), (3, "", "c")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, spans string")
    got = sorted((r["doc_id"], r["n_assign"], r["spans"]) for r in credentials.scan(docs).collect())
    assert got == [(1, 1, "assign:0:16")] * 2 + [(2, 0, ""), (3, 0, "")]
    assert credentials.scan(docs.limit(0)).collect() == []
    long = ("word " * 50_000) + "AKIA" + "B" * 20
    assert [str(s) for s in credentials.spans_of(long)[0]] == ["access:250000:250024"]


# Classifiers


def labelled_texts(n=400, seed=4):
    import random

    rnd = random.Random(seed)
    plain = [f"{a}{b}" for a in ("ta", "ri", "mo", "ke") for b in ("lon", "sar", "vit", "dun")]
    rows = []
    for i in range(n):
        words = rnd.choices(plain, k=rnd.randrange(20, 90))
        bad = i % 4 == 0
        junk = i % 3 == 0
        if bad:
            words[rnd.randrange(len(words))] = "grobian"
        if junk:
            words = [w + "#%&" for w in words]
        rows.append((i, " ".join(words), int(not junk), int(bad)))
    return rows


def accuracy(spark, module, label, modulus, held, limit):
    rows = labelled_texts()
    docs = spark.createDataFrame(
        [(i, t, "x") for i, t, _, _ in rows] + [(1000, None, ""), (1001, "", "")],
        "doc_id long, text string, score string",
    )
    labels = spark.createDataFrame(
        [(i, q, x) for i, _, q, x in rows], "doc_id long, quality int, toxic int"
    )
    learn = remainder(F.col("doc_id"), modulus) != held
    got = {r["doc_id"]: r["score"] for r in module.score(docs, labels, learn).collect()}
    assert len(got) == len(rows) + 2 and got[1000] == got[1001]
    assert all(0 <= s <= 1 for s in got.values())
    truth = {r[0]: r[2 if label == "quality" else 3] for r in rows}
    out = [i for i in truth if zlib.crc32(str(i).encode()) % modulus == held]
    return np.mean([(got[i] >= limit) == truth[i] for i in out])


def test_held_out_accuracy(spark):
    assert accuracy(spark, toxicity, "toxic", 5, 0, 0.5) > 0.95
    assert accuracy(spark, byte_cnn, "quality", 4, 2, 0.7) > 0.95


def test_labels_without_a_text_take_no_place_of_the_sample(spark):
    docs = spark.createDataFrame(
        [(i, f"text {i}") for i in range(20)] + [(None, "none"), (20, "long " * 50), (3, "text 3b")],
        "doc_id long, text string",
    )
    labels = spark.range(4000).select(
        F.col("id").alias("doc_id"), (F.col("id") % 2).cast("int").alias("quality")
    )
    got = sample(docs, labels, "quality", F.lit(True), rows=20, max_bytes=100)
    assert got["doc_id"].tolist() == list(range(20))
    assert got["text"].tolist() == [f"text {i}" for i in range(20)]
    assert got["label"].tolist() == [i % 2 for i in range(20)]
    few = sample(docs, labels, "quality", F.col("doc_id") != 5, rows=7, max_bytes=100)
    assert len(few) == 7 and 5 not in few["doc_id"].tolist()


def test_classifiers_without_labels_or_rows(spark):
    docs = spark.createDataFrame([(1, "a")], "doc_id long, text string")
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    for module, score in ((toxicity, 0.0), (byte_cnn, 0.5)):
        got = module.score(docs, labels, F.lit(True)).collect()
        assert got[0]["score"] == pytest.approx(score, abs=1e-6)
        assert module.score(docs.limit(0), labels, F.lit(True)).collect() == []


def test_every_byte_of_a_long_text_is_in_a_chunk():
    how = byte_cnn.Settings()
    rows = labelled_texts(200)
    frame = pd.DataFrame({"text": [r[1] for r in rows], "label": [r[2] for r in rows]})
    model = byte_cnn.fit(frame, how)
    for length in (1, how.chunk, how.chunk + 1, 5 * how.step + 3, 100_000):
        starts = byte_cnn._starts(length, how)
        assert starts[-1] + how.chunk >= length
        assert all(b - a < how.chunk for a, b in zip(starts, starts[1:]))
    texts = ["x", "ta lon " * 30_000, "", rows[0][1]]
    together = byte_cnn.scores(*utf8(pa.array(texts)), model, how)
    alone = [byte_cnn.scores(*utf8(pa.array([t])), model, how)[0] for t in texts]
    assert np.allclose(together, alone)


def test_pieces_of_a_long_text_have_all_grams(monkeypatch):
    how = toxicity.Settings()
    text = "".join(chr(97 + i * i % 23) for i in range(5_000))
    whole = toxicity._features(text, how)
    monkeypatch.setattr(toxicity, "PIECE", 100)
    assert np.array_equal(whole, toxicity._features(text, how))


def test_empty_spans_have_the_hash_of_nothing(spark):
    from strata.llm.queries import QUERIES

    assert "op5_credential_linking" in QUERIES
    assert hashlib.sha256(b"").hexdigest().startswith("e3b0c442")
