"""Cleaning, normalising, tokenising and measuring text (TXT-1 .. TXT-10)."""

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from caselode import profile as P

_SPLITTER = f"(?U){P.SPACE}+"


def let(value: Column, body) -> Column:
    """Evaluate ``value`` once and use it several times inside ``body``."""
    return F.element_at(F.transform(F.array(value), body), 1)


def computed(df: DataFrame, **columns: Column) -> DataFrame:
    """Add columns that are evaluated exactly once per row.

    The optimizer copies a plain derived column into every filter and every
    use of it.  For text work that repeats whole chains of patterns, and a
    filter drags them below a repartitioning.  It does not look through a generator.
    """
    row = F.struct(*(c.alias(name) for name, c in columns.items()))
    return df.select("*", F.inline(F.array(row)))


def strip(c: Column) -> Column:
    """Remove white space of every kind from both ends."""
    return F.btrim(c, F.lit(P.SPACES))


def words(c: Column) -> Column:
    """Number of runs of non-blank characters; 0 for null."""

    def count(t):
        return F.when(F.coalesce(t, F.lit("")) == "", 0).otherwise(F.size(F.split(t, _SPLITTER)))

    return let(strip(c), count)


def remove_literals(c: Column, literals=P.BOILERPLATE_LITERALS) -> Column:
    return reduce(lambda t, lit: F.replace(t, F.lit(lit), F.lit(" ")), literals, c)


def remove_patterns(c: Column, patterns=P.BOILERPLATE_PATTERNS) -> Column:
    rules = (f"(?iU){p.format(s=P.SPACE)}" for p in patterns)
    return reduce(lambda t, rule: F.regexp_replace(t, rule, " "), rules, c)


def collapse_blanks(c: Column) -> Column:
    c = F.regexp_replace(c, "[ \t]+", " ")
    return strip(F.regexp_replace(c, "\n{3,}", "\n\n"))


def clean(c: Column) -> Column:
    """Text without page headers, footers and watermarks (TXT-1, 2, 3)."""
    return collapse_blanks(remove_patterns(remove_literals(c)))


def normalise(c: Column) -> Column:
    """Lower case, printable characters only, repeated punctuation collapsed (TXT-4).

    Blank lines collapse *before* the blanks around line ends go, so some
    runs of line ends survive; later stages rely on that order.
    """
    c = F.regexp_replace(F.lower(c), P.DROPPED_CHARACTERS, " ")
    c = F.regexp_replace(c, r"([.,;:])\1+", "$1")
    c = F.regexp_replace(c, " +", " ")
    c = F.regexp_replace(c, "\n{3,}", "\n\n")
    c = F.regexp_replace(c, " ?\n ?", "\n")
    return F.btrim(c, F.lit(" \n"))


def tokens(c: Column) -> Column:
    """ASCII words; hyphens and apostrophes inside a word are kept (TXT-5)."""
    return F.regexp_extract_all(F.lower(c), F.lit(P.WORD_TOKEN), F.lit(0))


def content_words(c: Column) -> Column:
    """Words outside boilerplate lines (TXT-7)."""

    def kept(line):
        marked = reduce(lambda a, b: a | b, (line.contains(m) for m in P.BOILERPLATE_MARKERS))
        return ~(marked | line.rlike(P.HEADLINE))

    lines = F.filter(F.split(F.lower(c), P.LINE_BREAK), kept)
    return words(F.array_join(lines, "\n"))


def completeness(kept: Column, all_words: Column) -> Column:
    """Share of the raw content words that survive cleaning, 0 to 1 (TXT-8).

    A blank text has no words, so the two zero cases cover it.
    """
    return F.when((all_words == 0) | (kept == 0), F.lit(0.0)).otherwise(
        F.least(kept / all_words, F.lit(1.0))
    )


def is_valid(n_words: Column, score: Column) -> Column:
    return (n_words >= P.MIN_WORDS) & (score >= P.MIN_COMPLETENESS)


def blank_to_empty(c: Column) -> Column:
    return F.coalesce(strip(c), F.lit(""))


def is_empty(c: Column) -> Column:
    return c.isNull() | (c == "")
