"""Quality rules, line first: bad lines go, then documents that lost too much text.

Only built-in functions; a row is judged by itself, so nothing is shuffled.

A line is what stands between \\n; it counts if it has a word `[^\\x20\\x09-\\x0D]+`. It fails if
  * it has at most 15 words, does not end in closing punctuation and is not wrapped (headings, menus),
  * more than 15 % of its characters other than white space, one closing mark aside, are ASCII punctuation,
  * it has more than one symbol `#*$%&|<>` for ten words (tables, menus, noise),
  * it is short and has a menu phrase, or at most 30 words and a boilerplate phrase,
  * it equals an earlier line of the text.
A line is wrapped if its paragraph goes on in the next line: that begins with a lower-case letter, or the line
has at least 60 characters and the next one is not blank. So prose that is broken at 70 or 80 columns is judged
like prose with a paragraph on each line.
The cleaned text is the lines that pass, joined by \\n. The verdict on the document: it is rejected if
it fails the base (fewer than 50 words, or more than half of its words in 3-word windows that it has
twice) or if more than `max_lost` percent of its words stand on failing lines.

Defined results: null text counts as empty (no words, base failed, cleaned text null); every row gets
its own result, so repeated rows and null ids are kept as they are; a text of one huge line is one line.
Windows are compared by a 64-bit hash within one text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: The contract's white space and symbols, closing punctuation, and phrases.
BLANK = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]"
SYMBOL = r"[#*$%&|<>]"
PUNCTUATION = r"[!-/:-@\[-`{-~]"
CLOSED = r"[.!?…:;。！？\"'”’»)\]][\x20\x09-\x0D]*\z"
MENU = (
    "home|log ?in|sign ?in|sign ?up|menu|skip to content|next page|previous page|read more|back to top"
    "|click here|share this|subscribe|site map|contact us|about us|follow us"
)
BOILERPLATE = (
    "all rights reserved|terms of (use|service)|privacy policy|cookie policy|we use cookies|enable javascript"
    "|lorem ipsum|copyright ©|powered by|unsubscribe"
)
MENU_LINE = rf"(?i)(^|[^a-z0-9])({MENU})([^a-z0-9]|\z)"
BOILERPLATE_LINE = rf"(?i)({BOILERPLATE})"
LOWER = r"^[\x20\x09-\x0D]*\p{Ll}"
WRAPPED_CHARS = 60
MENU_WORDS, OPEN_WORDS, BOILERPLATE_WORDS = 8, 15, 30
MIN_WORDS, MAX_REPEATED, MAX_LOST = 50, 50, 50


def _words(text: Column) -> Column:
    return F.filter(F.split(text, BLANK), lambda w: w != "")


def _total(numbers: Column) -> Column:
    return F.aggregate(numbers, F.lit(0).cast("bigint"), lambda a, x: a + x)


def _line(line: Column, n: Column, wrapped: Column) -> Column:
    """What a line with n words is judged by, but for equal lines before it."""
    chars = F.length(F.regexp_replace(line, BLANK, ""))
    return (
        ((n <= OPEN_WORDS) & ~wrapped & ~line.rlike(CLOSED))
        | ((F.regexp_count(line, F.lit(PUNCTUATION)) - 1) * 100 > chars * 15)
        | (F.regexp_count(line, F.lit(SYMBOL)) * 10 > n)
        | ((n <= MENU_WORDS) & line.rlike(MENU_LINE))
        | ((n <= BOILERPLATE_WORDS) & line.rlike(BOILERPLATE_LINE))
    )


def _repeats(keys: Column) -> Column:
    """Indexes, unsorted, of array entries that equal an earlier one; by sorting, not by pairs."""
    return F.transform(
        F.filter(F.transform(keys, lambda k, j: F.struct(k.k, k.i, F.get(keys, j - 1).k.alias("before"))), lambda x: x.k == x.before),
        lambda x: x.i,
    )


def judged(docs: DataFrame, max_lost: int = MAX_LOST) -> DataFrame:
    """A row for each document: `d`, a struct of its columns, and the measures and verdict.

    Beside `d`: n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_lines, n_bad_lines,
    lost_words (bigint), base_failed, kept (boolean), cleaned (string).
    """
    rows = _judged(docs, max_lost)
    # A filter would be pushed below the projections, and every rule written out in it again and again.
    return rows.select(F.inline(F.array(F.struct(*rows.columns))))


def _judged(docs: DataFrame, max_lost: int) -> DataFrame:
    text = F.col("text")
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("d"), F.coalesce(docs["text"], F.lit("")).alias("text"))
    rows = rows.select(
        "d",
        "text",
        _words(text).alias("words"),
        F.split(text, "\n").alias("parts"),
    )
    after = lambda i: F.coalesce(F.get("parts", i + 1), F.lit(""))
    wrapped = lambda x, i: after(i).rlike(LOWER) | ((F.length(x) >= WRAPPED_CHARS) & after(i).rlike(WORD))
    rows = rows.select(
        "d",
        "text",
        "words",
        F.filter("parts", lambda x: x.rlike(WORD)).alias("lines"),
        F.filter(F.transform("parts", lambda x, i: F.when(x.rlike(WORD), wrapped(x, i))), lambda w: w.isNotNull()).alias("wraps"),
    )
    n = F.size("words").cast("bigint")
    rows = rows.select(
        "d",
        "lines",
        "wraps",
        n.alias("n_words"),
        F.length(F.array_join("words", "")).cast("bigint").alias("word_chars"),
        F.regexp_count(text, F.lit(SYMBOL)).cast("bigint").alias("n_symbols"),
        F.when(
            n > 3,
            F.transform(
                F.sequence(F.lit(0), F.size("words") - 3),
                lambda i: F.xxhash64(F.get("words", i), F.get("words", i + 1), F.get("words", i + 2)),
            ),
        ).alias("windows"),
        F.transform("lines", lambda x: F.size(_words(x))).alias("sizes"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("bigint").alias("n_dup_lines"),
    )
    keyed = lambda c: F.sort_array(F.transform(c, lambda k, i: F.struct(k.alias("k"), i.alias("i"))))
    rows = rows.select(
        "*",
        F.when(F.size(F.array_distinct("windows")) < F.size("windows"), keyed("windows")).alias("by_window"),
        F.when(F.col("n_dup_lines") > 0, keyed("lines")).alias("by_line"),
    )
    w = F.col("by_window")
    again = F.filter(
        F.transform(w, lambda k, j: F.when((k.k == F.get(w, j - 1).k) | (k.k == F.get(w, j + 1).k), k.i)),
        lambda i: i.isNotNull(),
    )
    rows = rows.select("*", F.sort_array(again).alias("again"), F.array_sort(_repeats(F.col("by_line"))).alias("copies"))
    again = F.col("again")
    covered = F.transform(again, lambda p, j: F.least(F.lit(3), F.coalesce(F.get(again, j + 1) - p, F.lit(3))))
    copied = F.coalesce(F.col("copies"), F.expr("array()").cast("array<int>"))
    flags = F.transform(
        "lines",
        lambda x, i: _line(x, F.get("sizes", i), F.get("wraps", i)),
    )
    rows = rows.select(
        "d", "n_words", "word_chars", "n_symbols", "n_dup_lines", "lines", "sizes",
        F.coalesce(_total(covered), F.lit(0).cast("bigint")).alias("n_repeat_words"),
        flags.alias("flags"), copied.alias("copies"),
    )
    rows = rows.select("*", F.when(F.size("copies") > 0, _marked(F.size("lines"), F.col("copies"))).alias("marks"))
    bad = lambda f, i: f | F.coalesce(F.get("marks", i), F.lit(False))
    rows = rows.select("*", F.transform("flags", bad).alias("bad"))
    lost = _total(F.transform("sizes", lambda s, i: F.when(F.get("bad", i), s).otherwise(0)))
    rows = rows.select(
        "d", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        F.size("lines").cast("bigint").alias("n_lines"),
        F.size(F.filter("bad", lambda b: b)).cast("bigint").alias("n_bad_lines"),
        lost.alias("lost_words"),
        ((F.col("n_words") < MIN_WORDS) | (F.col("n_repeat_words") * 100 > F.col("n_words") * MAX_REPEATED)).alias("base_failed"),
        F.array_join(F.filter("lines", lambda x, i: ~F.get("bad", i)), "\n").alias("cleaned"),
    )
    return rows.select(
        *[c for c in rows.columns if c != "cleaned"],
        (~F.col("base_failed") & (F.col("lost_words") * 100 <= F.col("n_words") * max_lost)).alias("kept"),
        F.when(F.col("d.text").isNotNull(), F.col("cleaned")).alias("cleaned"),
    )


def _marked(n: Column, places: Column) -> Column:
    """An array of n booleans that is true at the given sorted places."""
    gaps = F.transform(places, lambda p, j: F.array_repeat(F.lit(False), (p - F.coalesce(F.get(places, j - 1), F.lit(-1)) - 1).cast("int")))
    head = F.flatten(F.transform(gaps, lambda g: F.concat(g, F.array(F.lit(True)))))
    return F.concat(head, F.array_repeat(F.lit(False), (n - F.element_at(places, -1) - 1).cast("int")))


def clean(docs: DataFrame, max_lost: int = MAX_LOST) -> DataFrame:
    """The documents that are kept, with failing lines removed from `text`; `n_chars` follows the text.

    The columns are those of `docs`, in their order.
    """
    rows = _judged(docs, max_lost)
    new = {"text": F.col("cleaned"), "n_chars": F.length("cleaned").cast("bigint")}
    kinds = dict(docs.dtypes)
    kept = F.struct(*[(new[c].cast(kinds[c]) if c in new else F.col(f"d.`{c}`")).alias(c) for c in docs.columns])
    # As in `judged`, instead of a filter.
    return rows.select(F.inline(F.when(F.col("kept"), F.array(kept))))
