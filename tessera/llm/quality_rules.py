"""Line-first cleaning in DataFrame expressions only: rules judge each line, failing lines go, and
documents that lose too much text are rejected."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import SEPARATORS, only, words

#: Phrases of page furniture, compared in lower case.
BOILERPLATE = ("all rights reserved", "cookie policy", "privacy policy", "terms of use", "terms of service", "lorem ipsum", "enable javascript", "click here", "sign up for our newsletter", "subscribe to our newsletter", "powered by wordpress")
SYMBOLS = "#*$%&|<>"
WINDOW = 8


def _repeated_words(df: DataFrame) -> DataFrame:
    """Adds n_repeat_words: words covered by 8-word windows that occur twice or more. Windows are
    compared by 64-bit hashes of hashed words."""
    df = df.withColumn("h", F.transform("w", lambda x: F.xxhash64(x)))
    windows = F.transform(F.sequence(F.lit(1), F.col("n_words").cast("int") - (WINDOW - 1)), lambda i: F.xxhash64(F.slice("h", i, F.lit(WINDOW))))
    df = df.withColumn("g", F.when(F.col("n_words") > WINDOW, windows))
    by_hash = F.array_sort(F.transform("g", lambda x, i: F.struct(x.alias("x"), i.alias("at"))))
    df = df.withColumn("s", F.when(F.size(F.array_distinct("g")) < F.size("g"), by_hash))

    def twice(item: Column, i: Column) -> Column:
        before = (i > 0) & (F.get("s", i - 1)["x"] == item["x"])
        return before | F.coalesce(F.get("s", i + 1)["x"] == item["x"], F.lit(False))

    df = df.withColumn("p", F.array_sort(F.transform(F.filter("s", twice), lambda x: x["at"])))
    steps = F.transform("p", lambda at, i: F.least(F.lit(WINDOW), F.coalesce(F.get("p", i + 1) - at, F.lit(WINDOW))))
    return df.withColumn("n_repeat_words", F.coalesce(F.aggregate(steps, F.lit(0).cast("long"), lambda a, x: a + x), F.lit(0).cast("long")))


def _line_stays(line: Column, symbols: Column, phrases: Column) -> Column:
    """Punctuation: a line of three words or more ends a sentence somewhere or at its end, and no
    more than a quarter of its words carry runs of symbols or doubled exclamation marks.
    Navigation: at most one item separator for each four words. Boilerplate: none of the phrases.
    `symbols` and `phrases` say that the whole text has runs or phrases at all."""
    n = F.size(F.filter(F.split(line, SEPARATORS), lambda w: w != ""))
    runs = F.size(F.regexp_extract_all(line, F.lit("[#*$%&<>]{2,}|!{2,}"), F.lit(0)))
    items = F.length(line) - F.length(F.regexp_replace(line, "[|»›•]", ""))
    sentence = F.right(line, F.lit(6)).rlike("[.!?…。！？:;][\"'”»)\\]]*[\\x20\\x09-\\x0D]*$") | line.rlike("[.!?…]\\x20") | (n < 3)
    clean = (~symbols | (runs == 0) | (4 * runs <= n)) & ((items == 0) | (4 * items <= n))
    return sentence & clean & (~phrases | ~F.lower(line).rlike("|".join(BOILERPLATE)))


def clean_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", max_loss: float = 0.5, min_words: int = 20, max_repeat: float = 0.3) -> DataFrame:
    """One row per row of `docs`: doc_id, the base counts, base_failed, kept and clean_text.

    Null texts are empty: no words, so they fail the base rules. clean_text holds the lines that pass
    (lines without a word stay as they are); a document is kept if it passes the base rules and
    loses at most `max_loss` of the characters of its words' lines. Ids may be null or repeat; each
    row is judged alone, and other columns are ignored. Nothing is shuffled.
    """
    df = only(docs, doc_id=id_col, text=text_col).withColumn("text", F.coalesce("text", F.lit("")))
    small = F.lower("text")
    phrases = reduce(Column.__or__, [small.contains(p) for p in BOILERPLATE])
    df = df.withColumns({"w": words(F.col("text")), "lines": F.split("text", "\n"), "symbols": F.col("text").rlike("[#*$%&<>]{2}|!!"), "phrases": phrases})
    df = df.withColumns({"n_words": F.size("w").cast("long"), "full": F.filter("lines", lambda x: x.rlike("[^\\x20\\x09-\\x0D]"))})
    df = _repeated_words(df)
    df = df.withColumns({
        "word_chars": F.length(F.regexp_replace("text", SEPARATORS, "")).cast("long"),
        "n_symbols": (F.length("text") - F.length(F.regexp_replace("text", f"[{SYMBOLS}]", ""))).cast("long"),
        "n_dup_lines": (F.size("full") - F.size(F.array_distinct("full"))).cast("long"),
        "clean_lines": F.filter("lines", lambda x: ~x.rlike("[^\\x20\\x09-\\x0D]") | _line_stays(x, F.col("symbols"), F.col("phrases"))),
    })
    chars = lambda lines: F.aggregate(lines, F.lit(0), lambda a, x: a + F.length(x))
    failed = (F.col("n_words") < min_words) | (100 * F.col("n_repeat_words") > round(100 * max_repeat) * F.col("n_words"))
    df = df.withColumns({"base_failed": failed, "lost": chars(F.col("lines")) - chars(F.col("clean_lines")), "all": chars(F.col("lines"))})
    kept = ~F.col("base_failed") & (F.col("lost") <= max_loss * F.col("all"))
    return df.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", kept.alias("kept"), F.array_join("clean_lines", "\n").alias("clean_text"))
