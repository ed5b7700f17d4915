"""Quality rules, line first (native SQL functions only).

Every line is judged by itself: punctuation and symbol rules, navigation
rules, repetition within the line and boilerplate phrases. Failing lines are
taken out; a document that loses too much of its text, or fails the base rule
on its whole text, is rejected.

Defined results: a NULL text counts as empty; an empty text has zero counts,
fails the base rule (fewer than 50 words) and is rejected. Blank lines are
never judged and stay. Very long texts cost n log n in their words. Repeated
rows are judged row by row; an empty table gives no rows; other columns of the
input but ``_f`` pass through unless
their names are those of the results, which then replace them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tenderfold.llm.common import WORD_SPACE, let, words

MIN_WORDS = 50              # base rule: fewer words fail
MAX_REPEAT_PERCENT = 50     # base rule: more words inside repeated 3-word windows fail
MAX_LOST_PERCENT = 50       # a document that loses more of its non-space characters is rejected

# Symbols counted by the base rule, and phrases of boilerplate lines.
SYMBOLS = "#*$%&|<>"
BOILERPLATE_START = ["licensed under ", "this work is licensed under "]
BOILERPLATE = ["all rights reserved", "privacy policy", "terms of use", "terms of service", "cookie policy",
               "cookie settings", "accept cookies", "accept all cookies", "click here", "sign up for our",
               "subscribe to our", "skip to content", "skip to main content"]
NAVIGATION_MARKS = "|»›•·"

MAX_SYMBOL_PERCENT = 10     # symbols among the non-space characters of a line
MAX_MARK_PERCENT = 20       # navigation marks per 100 words of a line
MAX_BANG_PERCENT = 33       # "!!" per 100 words of a line
MIN_CAPS_WORDS = 4          # an all-capitals line of at least so many words fails
LONG_LINE_WORDS = 10        # repetition is judged from this length on
MIN_DISTINCT_PERCENT = 25   # distinct words among the words of a long line
UNPUNCTUATED_WORDS = 30     # a line of so many words without any punctuation fails


def _count(text: Column, chars: str) -> Column:
    return F.length(text) - F.length(F.translate(text, chars, ""))


def _count_text(text: Column, part: str) -> Column:
    return (F.length(text) - F.length(F.replace(text, F.lit(part), F.lit("")))) / len(part)


def _solid(w: Column) -> Column:
    """Characters outside white space, from the words."""
    return F.length(F.array_join(w, ""))


def line_fault(line: Column, w: Column) -> Column:
    """Name of the first rule that a line with the words ``w`` fails, or NULL. Blank lines never fail."""
    marked = (F.when(_count(line, NAVIGATION_MARKS) * 100 > F.size(w) * MAX_MARK_PERCENT, F.lit("navigation"))
              .when(_count(line, SYMBOLS) * 100 > _solid(w) * MAX_SYMBOL_PERCENT, F.lit("symbols"))
              .when(_count_text(line, "!!") * 100 > F.size(w) * MAX_BANG_PERCENT, F.lit("exclamation")))
    def boilerplate(low: Column) -> Column:
        found = F.contains(low, F.lit(BOILERPLATE[0]))
        for p in BOILERPLATE[1:]:
            found = found | F.contains(low, F.lit(p))
        for p in BOILERPLATE_START:
            found = found | F.startswith(low, F.lit(p))
        return found

    capitals = ((F.size(w) >= MIN_CAPS_WORDS) & (w[0] == F.upper(w[0]))
                & (line == F.upper(line)) & (line != F.lower(line)))
    repetitive = ((F.size(w) >= LONG_LINE_WORDS)
                  & (F.size(F.array_distinct(w)) * 100 < F.size(w) * MIN_DISTINCT_PERCENT))
    return F.when(F.size(w) > 0, F.coalesce(
        F.when(line.rlike(f"[{SYMBOLS}{NAVIGATION_MARKS}!]"), marked),      # most lines have none of them
        F.when(capitals, F.lit("capitals"))
        .when(repetitive, F.lit("repetition"))
        .when((F.size(w) >= UNPUNCTUATED_WORDS) & ~line.rlike("[.,;:!?…。、]"), F.lit("unpunctuated"))
        .when(let(F.lower(F.btrim(line)), boilerplate), F.lit("boilerplate"))))


def repeated_words(w: Column) -> Column:
    """Words of the array ``w`` that lie in a 3-word window found at least twice (its first place included).

    Windows are compared by their 64-bit hash (the words' hashes are chained,
    so the cut between words counts); within one text of a million words two
    different windows agree with a chance of about 3e-8.
    """
    hashes = F.transform(F.sequence(F.lit(0), F.size(w) - 3), lambda i: F.xxhash64(w[i], w[i + 1], w[i + 2]))

    def positions(s: Column) -> Column:
        # after sorting, equal windows are neighbours
        hits = F.filter(s, lambda x, k: (
            ((k > 0) & (F.get(s, k - 1)["g"] == x["g"])) | ((k < F.size(s) - 1) & (F.get(s, k + 1)["g"] == x["g"]))))
        return F.size(F.array_distinct(F.flatten(
            F.transform(hits, lambda x: F.array(x["i"], x["i"] + 1, x["i"] + 2)))))

    def placed(g: Column) -> Column:
        return F.sort_array(F.transform(g, lambda h, i: F.struct(h.alias("g"), i.alias("i"))))

    return F.when(F.size(w) < 4, F.lit(0)).otherwise(let(hashes, lambda g: (
        F.when(F.size(F.array_distinct(g)) == F.size(g), F.lit(0)).otherwise(let(placed(g), positions)))))


def judge(docs: DataFrame, text: str = "text") -> DataFrame:
    """Add the base counts, the lines' verdicts and the cleaned text to each document.

    Added columns: n_words, word_chars, n_symbols, n_dup_lines,
    n_repeat_words, base_failed, kept, n_lines_removed, lost_chars,
    clean_text (the text without its failing lines; NULL text stays NULL).
    """
    t = F.coalesce(F.col(text), F.lit(""))
    lines = F.transform(F.split(t, "\n"), lambda x: F.struct(x.alias("line"), words(x).alias("w")))

    def facts(parsed: Column) -> Column:
        def with_kept(good: Column) -> Column:
            def with_words(w: Column) -> Column:
                solid = F.filter(parsed, lambda x: F.size(x["w"]) > 0)["line"]
                return F.struct(
                    F.size(w).cast("long").alias("n"), _solid(w).cast("long").alias("chars"),
                    repeated_words(w).cast("long").alias("repeated"),
                    let(solid, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("dup"),
                    (F.size(parsed) - F.size(good)).cast("long").alias("removed"),
                    F.when(F.size(parsed) == F.size(good), _solid(w)).otherwise(
                        _solid(F.flatten(good["w"]))).cast("long").alias("left"),
                    F.array_join(good["line"], "\n").alias("clean"))
            return let(F.flatten(parsed["w"]), with_words)
        return let(F.filter(parsed, lambda x: line_fault(x["line"], x["w"]).isNull()), with_kept)

    out = docs.withColumns({"_f": let(lines, facts),
                            "n_symbols": F.when(t.rlike(f"[{SYMBOLS}]"), _count(t, SYMBOLS)).otherwise(0).cast("long")})
    out = out.withColumns({
        "n_words": F.col("_f.n"), "word_chars": F.col("_f.chars"), "n_repeat_words": F.col("_f.repeated"),
        "n_dup_lines": F.col("_f.dup"), "n_lines_removed": F.col("_f.removed"),
        "lost_chars": F.col("_f.chars") - F.col("_f.left"),
        "clean_text": F.when(F.col(text).isNotNull(), F.col("_f.clean"))})
    out = out.withColumn("base_failed", (F.col("n_words") < MIN_WORDS)
                         | (F.col("n_repeat_words") * 100 > F.col("n_words") * MAX_REPEAT_PERCENT))
    return out.withColumn("kept", ~F.col("base_failed")
                          & (F.col("lost_chars") * 100 <= F.col("word_chars") * MAX_LOST_PERCENT)).drop("_f")
