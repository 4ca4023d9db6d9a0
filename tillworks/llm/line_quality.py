"""Quality rules, line first: drop failing lines, then reject documents that lose too much text.

DataFrame functions only. Words, lines and word windows stay in the row, so nothing is shuffled.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F

from tillworks.llm.common import ASCII_SPACE, spare, text_of

SYMBOLS = "#*$%&|<>"
#: Thresholds of the line rules and of the verdict.
SYMBOL_WORDS = 0.3  # more symbols a word than this
SHOUT_WORDS = 0.3  # more exclamation marks a word than this
BARE_WORDS = 12  # as many words without any punctuation
MENU_BARS = 3  # as many bars or arrows between short labels
REPEAT_WORDS, DISTINCT_WORDS = 20, 0.3  # in lines of so many words, fewer distinct ones than this
MOST_LOST = 0.5  # of the characters in words
BOILERPLATE = (
    r"(?i)all rights reserved|cookie (policy|settings|consent)|we use cookies|accept (all )?cookies|privacy policy|"
    r"terms (of|and) (use|service|conditions)|(enable|requires?) javascript|subscribe to our|sign up for|click here|"
    r"lorem ipsum|skip to (main )?content|powered by wordpress"
)
NAVIGATION = r"(?i)^\s*((home|login|log in|logout|sign in|register|menu|next|previous|back to top|share|print|contact( us)?|about( us)?|sitemap|search|faq|help)[\s|>/·»-]*)+$"


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Compute `value` once and use it in `body` as often as needed."""
    return F.transform(F.array(value), body)[0]


def words(text: Column) -> Column:
    return F.filter(F.split(F.translate(text, ASCII_SPACE, " " * len(ASCII_SPACE)), " "), lambda w: w != "")


def repeated_words(ws: Column) -> Column:
    """Words in three-word windows found twice or more, the first one included.

    Windows are sorted by hash, so equal ones are neighbours; positions of repeated windows, sorted,
    cover three words each, less what the next one covers too. Nothing is quadratic in the text."""

    def covered(at: Column) -> Column:
        new = F.transform(at, lambda p, i: F.least(F.lit(3), F.coalesce(F.get(at, i + 1) - p, F.lit(3))))
        return F.aggregate(new, F.lit(0), lambda a, x: a + x)

    def repeats(s: Column) -> Column:
        same = F.filter(
            s,
            lambda x, i: F.coalesce(F.get(s, i - 1)["h"] == x["h"], F.lit(False))
            | F.coalesce(F.get(s, i + 1)["h"] == x["h"], F.lit(False)),
        )
        return F.sort_array(F.transform(same, lambda x: x["i"]))

    def windows(w: Column) -> Column:
        return F.transform(
            F.sequence(F.lit(0), F.size(w) - 3),
            lambda i: F.struct(F.xxhash64(F.get(w, i), F.get(w, i + 1), F.get(w, i + 2)).alias("h"), i.alias("i")),
        )

    return _let(
        ws, lambda w: F.when(F.size(w) < 4, 0).otherwise(_let(_let(F.sort_array(windows(w)), repeats), covered))
    )


def line_fails(line: Column) -> Column:
    """Whether a rule on punctuation, navigation, boilerplate or repetition drops the line.
    Lines without a word never fail."""

    def rules(w: Column) -> Column:
        n = F.size(w)
        symbols = F.length(line) - F.length(F.translate(line, SYMBOLS, ""))
        shouts = F.length(line) - F.length(F.translate(line, "!", ""))
        return (n > 0) & (
            (symbols > SYMBOL_WORDS * n)
            | (shouts > SHOUT_WORDS * n)
            | ((n >= BARE_WORDS) & (F.translate(line, ".,;:!?…。，、؟।", "") == line))
            | (F.length(line) - F.length(F.translate(line, "|»›", "")) >= MENU_BARS)
            | line.rlike(NAVIGATION)
            | line.rlike(BOILERPLATE)
            | ((n >= REPEAT_WORDS) & (F.size(F.array_distinct(w)) < DISTINCT_WORDS * n))
        )

    return _let(words(line), rules)


def judged(text: Column) -> Column:
    """A struct with the base counts, the verdict and the cleaned text.

    What is used more than once is bound by `_let`: were it a column of its own, a filter that the
    optimizer pushes below would put it into the functions that run for every element."""

    def counts(w: Column, lines: Column) -> Column:
        written = F.transform(F.filter(lines, lambda l: l["chars"] > 0), lambda l: l["line"])
        good = F.filter(lines, lambda l: ~l["bad"])
        return F.struct(
            F.size(w).cast("long").alias("n_words"),
            F.length(F.translate(text, ASCII_SPACE, "")).cast("long").alias("word_chars"),
            (F.length(text) - F.length(F.translate(text, SYMBOLS, ""))).cast("long").alias("n_symbols"),
            _let(written, lambda l: F.size(l) - F.size(F.array_distinct(l))).cast("long").alias("n_dup_lines"),
            repeated_words(w).cast("long").alias("n_repeat_words"),
            F.size(F.filter(lines, lambda l: l["bad"])).cast("long").alias("lines_dropped"),
            F.aggregate(lines, F.lit(0), lambda a, l: a + F.when(l["bad"], l["chars"]).otherwise(0)).cast("long").alias("chars_dropped"),
            F.array_join(F.transform(good, lambda l: l["line"]), "\n").alias("clean"),
        )

    def verdict(c: Column) -> Column:
        base = (c["n_words"] < 50) | (100 * c["n_repeat_words"] > 50 * c["n_words"])
        enough = c["chars_dropped"] <= MOST_LOST * c["word_chars"]
        return c.withField("base_failed", base).withField("kept", ~base & enough)

    lines = F.transform(
        F.split(text, "\n"),
        lambda l: F.struct(l.alias("line"), F.length(F.translate(l, ASCII_SPACE, "")).alias("chars"), line_fails(l).alias("bad")),
    )
    return _let(_let(words(text), lambda w: _let(lines, lambda l: counts(w, l))), verdict)


def quality(docs: DataFrame) -> DataFrame:
    """One row per row of `docs`: doc_id, base counts, base_failed, kept, lines_dropped, chars_dropped.

    Null or empty text has no words and fails the base. Repeated rows are judged alike; an empty
    table gives an empty result."""
    rows = docs.select("doc_id", judged(text_of()).alias("q"))
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "lines_dropped", "chars_dropped")
    return rows.select("doc_id", *[F.col(f"q.{n}").alias(n) for n in names])


def clean(docs: DataFrame) -> DataFrame:
    """The kept rows of `docs` with their failing lines taken out (and n_chars, if there, counted
    anew); the other columns as they are."""
    q = spare(docs.columns, "q")
    # a row for each kept document, from one evaluation: a filter would be pushed below and judge twice
    found = F.filter(F.array(judged(text_of())), lambda x: x["kept"])
    kept = docs.withColumn(q, F.explode(found))
    new = {"text": F.col(f"{q}.clean")}
    if "n_chars" in docs.columns:
        new["n_chars"] = F.length(f"{q}.clean").cast(docs.schema["n_chars"].dataType)
    return kept.withColumns(new).select(*docs.columns)
