"""Quality rules by distribution divergence, on built-in functions only.

A document has two histograms: character classes of the characters in its words, and
how often it uses the common words of its language. Each is compared with the median
histogram of all documents of that language by Jensen-Shannon distance. Digits are left
out: how many numbers a text holds says little about its quality. Documents and
languages that are too small to have a distribution are not judged by it.

Statistics are taken over every document. The common words of a language are the short
words that most of its documents use; ties go to the word that sorts first.

Defined results: NULL and empty texts have no words and fail the base rule; documents
with a NULL language are one language of their own; repeated rows count once each; an
empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strata.llm.frames import WORD, staged

#: Character classes, counted over the characters of words. What is in none of them and no
#: digit is a class too.
CLASSES = {
    "lower": r"\p{Ll}",
    "upper": r"\p{Lu}",
    "symbol": r"[#*$%&|<>]",
    "mark": r"[!\"'()+,\-./:;=?@\[\\\]^_`{}~]",
}
DIGIT = r"\p{Nd}"


RESULT = [
    "n_words",
    "word_chars",
    "n_symbols",
    "n_dup_lines",
    "n_repeat_words",
    "base_failed",
    "kept",
]


@dataclass(frozen=True)
class Rule:
    """Limits of the verdict. Distances are between 0 and 1."""

    min_class_words: int = 10
    min_words: int = 50
    min_language_documents: int = 20
    common_words: int = 20
    common_word_length: int = 4
    class_distance: float = 0.2
    word_distance: float = 0.35
    base_min_words: int = 10
    base_repeat_percent: int = 20


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with the value computed once, also where it is used in lambdas."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _count(text: Column, char_class: str) -> Column:
    """Characters of a class: what is left when runs of other characters are removed."""
    return F.length(F.regexp_replace(text, f"[^{_inner(char_class)}]+", ""))


def _inner(char_class: str) -> str:
    return char_class[1:-1] if char_class.startswith("[") else char_class


def _repeat_words(words: Column) -> Column:
    """Words inside a five-word window that the text has at least twice."""

    def covered(windows: Column) -> Column:
        placed = F.sort_array(
            F.transform(windows, lambda w, i: F.struct(w.alias("w"), i.alias("i")))
        )

        def repeated(rows: Column) -> Column:
            last = F.size(rows) - 1

            def twin(x: Column, j: Column) -> Column:
                before = (j > 0) & (F.get(rows, j - 1)["w"] == x["w"])
                after = (j < last) & (F.get(rows, j + 1)["w"] == x["w"])
                return before | after

            return F.sort_array(F.transform(F.filter(rows, twin), lambda x: x["i"]))

        # A window that starts d words after the one before adds at most d words.
        return F.aggregate(
            _let(placed, repeated),
            F.struct(F.lit(-5).alias("at"), F.lit(0).cast("long").alias("n")),
            lambda acc, i: F.struct(
                i.alias("at"), (acc["n"] + F.least(F.lit(5), i - acc["at"])).alias("n")
            ),
            lambda acc: acc["n"],
        )

    def windows_of(hashes: Column) -> Column:
        return F.transform(
            F.sequence(F.lit(0), F.size(hashes) - 5),
            lambda i: F.xxhash64(*[F.get(hashes, i + k) for k in range(5)]),
        )

    def count(windows: Column) -> Column:
        return F.when(
            F.size(F.array_distinct(windows)) == F.size(windows), F.lit(0).cast("long")
        ).otherwise(covered(windows))

    hashes = F.transform(words, lambda w: F.xxhash64(w))
    return F.when(F.size(words) < 6, F.lit(0).cast("long")).otherwise(
        _let(_let(hashes, windows_of), count)
    )


def _words(text: Column) -> Column:
    found = F.regexp_extract_all(text, F.lit(WORD), F.lit(0))
    return F.coalesce(found, F.array().cast("array<string>"))


def _histogram(joined: Column) -> Column:
    """Counts of the classes and of the characters of none, without digits.

    Most characters are lower-case letters, which stand in long runs. They are taken out
    first, and the other classes are counted in the little that is left.
    """
    first, *others = CLASSES.values()

    def with_rest(counts: Column) -> Column:
        total = F.aggregate(counts, F.lit(0), lambda a, x: a + x)
        known = F.slice(counts, 1, len(CLASSES))
        return F.concat(known, F.array(F.length(joined) - total))

    def count(left: Column) -> Column:
        lower = F.length(joined) - F.length(left)
        each = [_count(left, c) for c in (*others, DIGIT)]
        return _let(F.array(lower, *each), with_rest)

    return _let(F.regexp_replace(joined, f"{first}+", ""), count)


def base_counts(docs: DataFrame, text: str, rule: Rule = Rule()) -> DataFrame:
    """Add ``words``, ``classes`` and the base columns to a frame.

    ``classes`` holds the counts of each character class and of all other characters.
    """
    words, joined = F.col("words"), F.col("joined")
    lines = F.filter(F.split(F.col(text), "\n"), lambda x: x.rlike(WORD))
    seen = docs.withColumn("words", _words(F.col(text))).withColumn(
        "joined", F.array_join("words", "")
    )
    counted = seen.select(
        *[c for c in seen.columns if c != "joined"],
        F.size(words).cast("long").alias("n_words"),
        F.length(joined).cast("long").alias("word_chars"),
        _histogram(joined).alias("classes"),
        F.coalesce(
            _let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))), F.lit(0)
        )
        .cast("long")
        .alias("n_dup_lines"),
        _repeat_words(words).alias("n_repeat_words"),
    )
    symbols = F.col("classes")[list(CLASSES).index("symbol")]
    return counted.withColumns(
        {
            "n_symbols": symbols.cast("long"),
            "base_failed": (F.col("n_words") < rule.base_min_words)
            | (
                100 * F.col("n_repeat_words")
                > rule.base_repeat_percent * F.col("n_words")
            ),
        }
    )


def _shares(counts: Column) -> Column:
    """Counts as shares of their sum; an empty histogram stays zero."""
    total = F.aggregate(counts, F.lit(0.0), lambda a, x: a + x)


    def share(t: Column) -> Column:
        return F.transform(counts, lambda x: F.when(t > 0, x / t).otherwise(F.lit(0.0)))

    return _let(total, share)


def js_distance(p: Column, q: Column) -> Column:
    """Square root of the Jensen-Shannon divergence in bits of two share arrays."""

    def term(a: Column, b: Column) -> Column:
        return F.when(a > 0, a * F.log2(2 * a / (a + b))).otherwise(F.lit(0.0))

    terms = F.zip_with(p, q, lambda a, b: term(a, b) + term(b, a))
    divergence = F.aggregate(terms, F.lit(0.0), lambda s, x: s + x) / 2
    return F.sqrt(F.greatest(divergence, F.lit(0.0)))


def common_words(counted: DataFrame, language: str, rule: Rule) -> DataFrame:
    """One row per language: its common words in order of the documents that use them."""
    short = F.array_distinct(
        F.transform(
            F.filter(
                F.col("words"), lambda w: F.length(w) <= rule.common_word_length
            ),
            lambda w: F.lower(w),
        )
    )
    used = (
        counted.select(F.col(language).alias("language"), F.explode(short).alias("w"))
        .groupBy("language", "w")
        .agg(F.count(F.lit(1)).alias("docs"))
    )
    order = Window.partitionBy("language").orderBy(F.desc("docs"), "w")
    return (
        used.withColumn("rank", F.row_number().over(order))
        .filter(F.col("rank") <= rule.common_words)
        .groupBy("language")
        .agg(F.sort_array(F.collect_list(F.struct("rank", "w"))).alias("ranked"))
        .select("language", F.col("ranked.w").alias("common"))
    )


def _word_counts(words: Column, common: Column) -> Column:
    """Uses of each common word, and of all other words together.

    Lower case never has fewer characters, so a word that is longer than every common word
    is none of them, and is turned away by its length. Words hold no blanks, so the others
    are lowered as one text.
    """

    def lowered(longest: Column) -> Column:
        short = F.filter(words, lambda w: F.length(w) <= longest)
        return F.split(F.lower(F.array_join(short, " ")), " ")

    def uses(low: Column) -> Column:
        return F.transform(
            common, lambda k: F.size(low) - F.size(F.array_remove(low, k))
        )

    def with_rest(each: Column) -> Column:
        used = F.aggregate(each, F.lit(0), lambda a, x: a + x)
        return F.concat(each, F.array(F.size(words) - used))

    longest = F.array_max(F.transform(common, lambda k: F.length(k)))
    return _let(_let(_let(longest, lowered), uses), with_rest)


def _join_languages(df: DataFrame, languages: DataFrame, language: str) -> DataFrame:
    """Attach one row per language; a NULL language matches a NULL language.

    Both sides are keyed by a text that a NULL cannot share with a value, so that the
    join is an equi-join of any size; Spark broadcasts the languages when they are small.
    """


    def mark(name: str) -> Column:
        return F.coalesce(F.concat(F.lit("="), F.col(name)), F.lit(""))

    left = df.withColumn("language_key", mark(language))
    right = languages.withColumn("language_key", mark("language")).drop("language")
    return left.join(right, "language_key", "left").drop("language_key")


def divergences(
    docs: DataFrame,
    keep: Sequence[str],
    text: str = "text",
    language: str = "lang",
    rule: Rule = Rule(),
) -> DataFrame:
    """Base counts, both distances and the verdict ``kept``, beside the columns ``keep``.

    Columns of ``docs`` must not be named like the added ones; ``judge`` and
    ``keep_good`` take any frame. Two passes over the texts: one for the common words of
    the languages, reduced in each task before it is shuffled, and one for the counts of
    each row, which are staged. The medians and the verdicts come from that stage.
    """
    words = docs.select(F.col(language).alias("l"), _words(F.col(text)).alias("words"))
    # One row per language, staged: its size is known, so Spark broadcasts it if small.
    common = staged(common_words(words, "l", rule), "common-words")
    counted = staged(
        _join_languages(base_counts(docs, text, rule), common, language).select(
            *keep,
            F.col(language).alias("language"),
            *RESULT[:-1],
            _shares(F.col("classes")).alias("class_shares"),
            _shares(_word_counts(F.col("words"), F.col("common"))).alias("word_shares"),
        ),
        "divergence-counts",
    )
    reference = staged(_reference(counted, rule), "references")
    judged = _join_languages(counted, reference, "language")

    def distance(kind: str, min_words: int) -> Column:
        enough = (F.col("n_words") >= min_words) & (
            F.col(f"{kind}_documents") >= rule.min_language_documents
        )
        return F.when(
            enough, js_distance(F.col(f"{kind}_shares"), F.col(f"{kind}_median"))
        )

    return judged.withColumns(
        {
            "class_distance": distance("class", rule.min_class_words),
            "word_distance": distance("word", rule.min_words),
        }
    ).withColumn(
        "kept",
        ~F.col("base_failed")
        & F.coalesce(F.col("class_distance") <= rule.class_distance, F.lit(True))
        & F.coalesce(F.col("word_distance") <= rule.word_distance, F.lit(True)),
    )


def _reference(counted: DataFrame, rule: Rule) -> DataFrame:
    """Median share of each bin per language, over all documents that are long enough.

    Shares are counted as whole thousandths: at most 1,001 counts per language and bin,
    reduced in each task, give the exact median however many documents there are.
    """

    def bins(shares: Column, kind: str) -> Column:
        return F.transform(
            shares,
            lambda x, i: F.struct(
                F.lit(kind).alias("kind"),
                i.alias("bin"),
                F.round(x * 1000).cast("int").alias("share"),
            ),
        )

    def long_enough(name: str, kind: str, min_words: int) -> Column:
        held = F.when(F.col("n_words") >= min_words, bins(F.col(name), kind))
        return F.coalesce(held, F.array().cast(_BINS))

    shares = counted.select(
        "language",
        F.explode(
            F.concat(
                long_enough("class_shares", "c", rule.min_class_words),
                long_enough("word_shares", "w", rule.min_words),
            )
        ).alias("b"),
    )
    counts = shares.groupBy("language", "b.kind", "b.bin", "b.share").agg(
        F.count(F.lit(1)).alias("n")
    )
    of_bin = Window.partitionBy("language", "kind", "bin")
    medians = (
        counts.withColumn("documents", F.sum("n").over(of_bin))
        .withColumn("up_to", F.sum("n").over(of_bin.orderBy("share")))
        .filter(F.col("up_to") * 2 >= F.col("documents"))
        .groupBy("language", "kind", "bin")
        .agg(F.min("share").alias("median"), F.first("documents").alias("documents"))
    )
    mine = [F.when(F.col("kind") == k, F.struct("bin", "median")) for k in "cw"]
    means = [
        _shares(
            F.transform(
                F.sort_array(F.collect_list(m)), lambda x: x["median"].cast("double")
            )
        ).alias(name)
        for m, name in zip(mine, ("class_median", "word_median"))
    ]
    documents = [
        F.max(F.when(F.col("kind") == k, F.col("documents"))).alias(f"{name}_documents")
        for k, name in zip("cw", ("class", "word"))
    ]
    return medians.groupBy("language").agg(*means, *documents)


_BINS = "array<struct<kind:string,bin:int,share:int>>"

def judge(
    docs: DataFrame,
    id: str = "doc_id",
    text: str = "text",
    language: str = "lang",
    rule: Rule = Rule(),
) -> DataFrame:
    """One row per input row: id, base counts, distances and the verdict."""
    chosen = docs.select(
        F.col(id).alias("doc_id"), F.col(text).alias("text"), F.col(language).alias("lang")
    )
    return divergences(chosen, ["doc_id"], "text", "lang", rule).select(
        "doc_id", *RESULT, "class_distance", "word_distance"
    )


def keep_good(
    docs: DataFrame, text: str = "text", language: str = "lang", rule: Rule = Rule()
) -> DataFrame:
    """The rows that pass, with the columns they came with."""
    packed = docs.select(
        F.struct(*[docs[c] for c in docs.columns]).alias("row"),
        docs[text].alias("text"),
        docs[language].alias("lang"),
    )
    judged = divergences(packed, ["row"], "text", "lang", rule)
    return judged.filter("kept").select("row.*")
