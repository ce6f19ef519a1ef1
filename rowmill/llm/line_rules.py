"""Line-first cleaning: rules judge each line, failed lines go, a document that loses too much goes too.

Column expressions only, without a shuffle: every figure of a text is made from arrays in its own row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rowmill.llm.common import by_name, by_place

SPACES = " \t\n\x0b\f\r"
SPACE_CLASS = r"[\x20\x09-\x0D]"
SYMBOLS = "#*$%&|<>"
# What the rules look for; all patterns mean the same in Java's and in RE2's syntax.
SHOUTS = r"(!!|\?\?|\*\*|%%|&&|##|\$\$)"
MENU_MARKS = r"[|»›•·]"
MENU_WORDS = (r"(?i)(^|[^a-z])(click here|read more|next page|previous page|back to top|sign in|log in|"
              r"subscribe now|skip to content|share this)([^a-z]|$)")
BOILERPLATE = (r"(?i)(^|[^a-z])(all rights reserved|privacy policy|terms of (use|service)|cookie policy|"
               r"uses cookies|enable javascript|lorem ipsum|copyright [0-9(])")
SENTENCE_END = r"[.!?:;,…。！？\"'”»)\]][\x20\x09-\x0D]*$"
MOST_SHOUTS, MOST_MARKS, SHORT_WORDS, MOST_LOST = 2, 2, 4, 0.3


def words_of(text: Column) -> Column:
    return F.filter(F.split(text, SPACE_CLASS + "+"), lambda w: w != "")


def repeated_words(words: Column) -> Column:
    """Words that lie in a window of three words found twice or more in the array.

    Windows are compared by 64-bit hashes, sorted; only where two agree are places looked at, by a
    second sort. Each array is bound by a lambda, so that none is made anew for each element.
    """
    def covered(h: Column) -> Column:
        placed = F.array_sort(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("i"))))
        same = F.transform(F.array(placed), lambda s: F.array_sort(F.transform(
            F.filter(F.transform(s, lambda e, k: F.when(
                (F.get(s, k - 1)["h"] == e["h"]) | (F.get(s, k + 1)["h"] == e["h"]), e["i"])),
                lambda i: i.isNotNull()), lambda i: i)))
        # A window covers three words, or fewer up to the next repeated window.
        return F.element_at(F.transform(same, lambda p: F.aggregate(
            F.transform(p, lambda i, k: F.least(F.coalesce(F.get(p, k + 1) - i, F.lit(3)), F.lit(3))),
            F.lit(0).cast("long"), lambda a, b: a + b)), 1)

    hashes = F.transform(F.array(words), lambda w: F.transform(
        F.sequence(F.lit(0), F.size(w) - 3), lambda i: F.xxhash64(F.get(w, i), F.get(w, i + 1), F.get(w, i + 2))))
    total = F.transform(hashes, lambda h: F.when(F.size(F.array_distinct(h)) < F.size(h), covered(h)).otherwise(F.lit(0)))
    return F.when(F.size(words) >= 4, F.element_at(total, 1)).otherwise(F.lit(0)).cast("long")


def marks(line: Column, pattern: str) -> Column:
    return F.regexp_count(line, F.lit(pattern))


def n_chars(text: Column) -> Column:
    """Code points that are no white space."""
    return F.length(F.translate(text, SPACES, "")).cast("long")


ADDED = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "n_lines_failed", "clean_text", "lost", "kept")


def line_fails(line: Column) -> Column:
    """True for a line with shouting or symbol runs, of a menu, of boilerplate, or a short one without an end."""
    short = (F.size(F.split(F.trim(F.translate(line, "\t\x0b\f\r", "    ")), " +")) <= SHORT_WORDS) & ~line.rlike(SENTENCE_END)
    punctuation = (marks(line, SHOUTS) >= MOST_SHOUTS) | short
    navigation = (marks(line, MENU_MARKS) >= MOST_MARKS) | line.rlike(MENU_WORDS)
    return punctuation | navigation | line.rlike(BOILERPLATE)


def clean_lines(df: DataFrame, text: str = "text", most_lost: float = MOST_LOST, least_words: int = 50,
                most_repeated: int = 50) -> DataFrame:
    """``df`` with the base counts of its texts, the cleaned text, what it lost, and the verdict.

    Adds n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, n_lines_failed,
    clean_text, lost (share of the non-white characters) and kept; a column of such a name is replaced.
    A null text counts as empty; it has no words, so it fails the base rules and is not kept. Lines
    without a word are neither judged nor removed. Rows are independent: repeated rows and ids give
    repeated results, an empty table none.
    """
    plain, names = by_place(df, (text,), ADDED)
    body = F.coalesce(F.col(f"`{text}`").cast("string"), F.lit(""))
    lines = plain.withColumn("__text", body).withColumn("__lines", F.split("__text", "\n")).withColumn(
        "__words", words_of(F.col("__text")))
    spoken = F.filter("__lines", lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    good = F.filter("__lines", lambda x: ~(x.rlike(r"[^\x20\x09-\x0D]") & line_fails(x)))
    counted = lines.withColumns({
        "n_words": F.size("__words").cast("long"), "word_chars": n_chars(F.col("__text")),
        "n_symbols": F.length("__text").cast("long") - F.length(F.translate("__text", SYMBOLS, "")),
        "n_repeat_words": repeated_words(F.col("__words")), "__spoken": spoken, "__good": good})
    figures = counted.withColumns({
        "n_dup_lines": (F.size("__spoken") - F.size(F.array_distinct("__spoken"))).cast("long"),
        "base_failed": (F.col("n_words") < least_words) | (100 * F.col("n_repeat_words") > most_repeated * F.col("n_words")),
        "n_lines_failed": (F.size("__lines") - F.size("__good")).cast("long"),
        "clean_text": F.array_join("__good", "\n")})
    lost = F.when(F.col("word_chars") > 0, 1 - n_chars(F.col("clean_text")) / F.col("word_chars")).otherwise(F.lit(0.0))
    judged = figures.withColumn("lost", lost).withColumn("kept", ~F.col("base_failed") & (F.col("lost") <= most_lost))
    return by_name(judged.drop("__text", "__lines", "__words", "__spoken", "__good"), names)
