"""Quality rules: clean a document line by line, then reject it if too much text was lost."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabforge.llm.common import SPACE, WORD

GAP = r"[\x20\x09-\x0D]+"
SYMBOL = r"[#*$%&|<>]"
#: Marks that end a sentence, and what stands between the entries of a menu.
SENTENCE_END = r"[.!?…。！？]"
MENU_MARK = r"[|»›•·>]"
#: Phrases of page furniture, lower case.
BOILERPLATE = (
    "all rights reserved", "terms of use", "terms of service", "privacy policy", "cookie policy",
    "we use cookies", "accept cookies", "enable javascript", "javascript is disabled",
    "lorem ipsum", "click here", "read more", "sign up for our newsletter",
    "subscribe to our newsletter", "skip to content", "skip to main content", "back to top",
    "share on facebook", "share on twitter", "add to cart", "page not found",
)


def words_of(text: Column) -> Column:
    """The words of a text or line; none for null."""
    trimmed = F.btrim(text, F.lit(SPACE))
    return F.when(F.coalesce(F.length(trimmed), F.lit(0)) == 0, F.array().cast("array<string>")
                  ).otherwise(F.split(trimmed, GAP))


def word_counts(text: Column, window: int) -> Column:
    """``struct(n, repeats)``: words, and words inside windows that occur more than once.

    Each step binds its array by a lambda, so that no later one computes it again.  A hash set
    over the windows' hashes tells whether any repeat; only then windows are sorted with their
    positions, and the positions of repeated ones are covered in order."""

    def windows(h: Column) -> Column:
        starts = F.sequence(F.lit(0), F.greatest(F.size(h) - window, F.lit(0)))
        return F.when(F.size(h) >= window,
                      F.transform(starts, lambda i: F.xxhash64(*[F.get(h, i + k) for k in range(window)]))
                      ).otherwise(F.array().cast("array<bigint>"))

    def places(p: Column) -> Column:
        same = lambda x, k: (F.get(p, k + 1)["h"] == x["h"]) | (F.get(p, k - 1)["h"] == x["h"])
        hit = F.filter(p, lambda x, k: F.coalesce(same(x, k), F.lit(False)))
        return F.array_sort(F.transform(hit, lambda x: x["i"]))

    def union(at: Column) -> Column:
        return F.aggregate(
            at, F.struct(F.lit(0).alias("n"), F.lit(0).alias("upto")),
            lambda s, i: F.struct((s["n"] + i + window - F.greatest(i, s["upto"])).alias("n"),
                                  (i + window).alias("upto")), lambda s: s["n"])

    def covered(h: Column) -> Column:
        pairs = F.array_sort(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("i"))))
        return _let(_let(pairs, places), union)

    def repeats(h: Column) -> Column:
        return F.when(F.size(F.array_distinct(h)) < F.size(h), covered(h)).otherwise(F.lit(0))

    hashed = F.transform(words_of(text), lambda w: F.xxhash64(w))
    return _let(hashed, lambda h: F.struct(F.size(h).alias("n"),
                                           _let(windows(h), repeats).alias("repeats")))


def _let(value: Column, body) -> Column:
    """``body(value)`` with the value computed once."""
    return F.transform(F.array(value), body)[0]


def line_passes(line: Column) -> Column:
    """The line rules.  A line without words fails none (it is layout, not text).

    Punctuation: it holds a sentence end, and symbols and exclamation marks are fewer than half of
    its words.  Navigation: menu marks are fewer than a quarter of its words.  Boilerplate: no
    phrase of page furniture, however long the line.
    """
    words = F.regexp_count(line, F.lit(WORD))
    marked = F.regexp_count(line, F.lit(MENU_MARK)) * 4 >= words
    shouted = F.regexp_count(line, F.lit(r"[#*$%&|<>!]")) * 2 >= words
    furniture = F.lower(line).rlike("|".join(BOILERPLATE))
    return ~line.rlike(WORD) | (line.rlike(SENTENCE_END) & ~marked & ~shouted & ~furniture)


def apply_rules(docs: DataFrame, window: int = 8, min_words: int = 20, max_repeat_pct: int = 30,
                max_lost_pct: int = 50, text_col: str = "text") -> DataFrame:
    """``docs`` with the base counts ``n_words, word_chars, n_symbols, n_dup_lines,
    n_repeat_words``, ``base_failed``, the line counts ``n_lines_removed`` and ``lost_chars``,
    the ``cleaned`` text and ``kept``; columns of these names are replaced.

    A document is kept unless its base counts fail or the lines removed by :func:`line_passes`
    hold more than ``max_lost_pct`` percent of its word characters.  One scan of built-in
    expressions, no shuffle: a document's lines and windows stay arrays in its row.

    Null and empty texts have no words and fail; ``cleaned`` is then empty.  A line equal to an
    earlier one counts in ``n_dup_lines`` if it holds a word.  Windows are told apart by a 64-bit
    hash over their words' hashes.  Repeated rows are judged alike.
    """
    base = docs.withColumn("__text", F.coalesce(F.col(text_col).cast("string"), F.lit("")))
    lines = F.split(F.col("__text"), "\n")
    base = base.withColumns({
        "_words": word_counts(F.col("__text"), window),
        "_bad": F.filter(lines, lambda x: ~line_passes(x)),
        "cleaned": F.array_join(F.filter(lines, line_passes), "\n"),
        "_worded": F.filter(lines, lambda x: x.rlike(WORD)),
    })
    chars = lambda c: F.length(F.regexp_replace(c, GAP, "")).cast("long")
    out = base.withColumns({
        "n_words": F.col("_words.n").cast("long"),
        "word_chars": chars("__text"),
        "n_symbols": F.coalesce(F.regexp_count("__text", F.lit(SYMBOL)), F.lit(0)).cast("long"),
        "n_dup_lines": (F.size("_worded") - F.size(F.array_distinct("_worded"))).cast("long"),
        "n_repeat_words": F.col("_words.repeats").cast("long"),
        "n_lines_removed": F.size("_bad").cast("long"),
        "lost_chars": chars(F.array_join("_bad", "\n")),
    })
    out = out.withColumn("base_failed", (F.col("n_words") < min_words)
                         | (F.col("n_repeat_words") * 100 > F.col("n_words") * max_repeat_pct))
    lost = F.col("lost_chars") * 100 > F.col("word_chars") * max_lost_pct
    return out.withColumn("kept", ~F.col("base_failed") & ~lost).drop(
"__text", "_words", "_bad", "_worded")
