"""Structured fields of a decision, read from its normalised text (REP-2 .. REP-9).

Every function expects the output of ``text.normalise``: lower case, where blanks
and line ends are the only white space.
"""

from pyspark.sql import Column, functions as F

from caselode import profile as P
from caselode.functions.text import let, words


def _strip(c: Column) -> Column:
    return F.btrim(c, F.lit(" \n"))


def _find_all(c: Column, pattern: str, group: int) -> Column:
    return F.regexp_extract_all(c, F.lit(f"(?id){pattern}"), F.lit(group))


def _name(anchor: str, link: str) -> str:
    return f"([A-Z]{P.NAME_CHARACTER}+?){link}{anchor}"


def _names_in_runs(runs: Column, anchor: str, link: str) -> Column:
    """Names that stand before ``anchor`` inside one run of name characters each.

    The lazy name pattern retries from every letter, which is quadratic in the
    length of a run.  Cutting the run behind its last anchor first leaves the
    same names, since no name can start behind it, and takes linear time.
    """
    cut = rf"(?id)\A{P.NAME_CHARACTER}*{link}{anchor}"
    return F.flatten(
        F.transform(
            runs, lambda r: _find_all(F.regexp_extract(r, cut, 0), _name(anchor, link), 1)
        )
    )


def _names_across_runs(text: Column, anchor: str, link: str) -> Column:
    """The same for an anchor that may leave the run; ``\\G`` goes on inside a run."""
    ch = P.NAME_CHARACTER
    cuts = _find_all(text, rf"(?:\G|(?<!{ch})){ch}*{link}{anchor}", 0)
    return F.flatten(F.transform(cuts, lambda r: _find_all(r, _name(anchor, link), 1)))


def party_names(text: Column, party: str, alias: str) -> Column:
    """Up to five distinct names of one party, in order of appearance by rule."""
    hereafter, named_as = P.NAMED_HEREAFTER.format(party=party), P.NAMED_AS.format(party=party)
    runs = F.filter(F.split(text, P.NAME_GAP), lambda r: r.contains(party))

    def found(rs):
        as_party = F.when(
            text.contains(P.REPRESENTED), _names_across_runs(text, named_as, r"\s*")
        ).otherwise(_names_in_runs(rs, named_as, r"\s*"))
        return F.concat(
            _names_in_runs(rs, hereafter, r"\s*,?\s*"),
            as_party,
            _find_all(text, P.NAMED_AFTER.format(party=party), 1),
        )

    names = F.slice(
        F.array_distinct(
            F.filter(F.transform(let(runs, found), _strip), lambda n: F.length(n) > 3)
        ),
        1,
        P.MAX_PARTIES,
    )
    single = F.transform(
        F.slice(_find_all(text, P.NAMED_FALLBACK.format(party=party, alias=alias), 1), 1, 1),
        _strip,
    )
    return let(names, lambda n: F.when(F.size(n) > 0, n).otherwise(single))


def parties(text: Column, party: str, alias: str) -> Column:
    """struct(names, n): joined names and the estimated number of parties."""
    mentions = F.regexp_count(text, F.lit(party)) - F.regexp_count(text, F.lit(f"{party}:"))
    estimate = F.least(F.floor(mentions / 3).cast("int"), F.lit(10))
    return let(
        party_names(text, party, alias),
        lambda n: F.when(
            F.size(n) > 0,
            F.struct(
                F.array_join(n, "; ").alias("names"),
                F.greatest(F.lit(1), F.size(n), estimate).alias("n"),
            ),
        ).otherwise(F.struct(F.lit(P.NOT_DETECTED).alias("names"), F.lit(0).alias("n"))),
    )


def statutes(text: Column) -> Column:
    """The first ten distinct statute references, joined by commas."""
    found = F.transform(
        F.concat(*(_find_all(text, p, 0) for p in P.STATUTE_PATTERNS)), _strip
    )

    def joined(raw):
        keys = F.transform(raw, lambda r: F.regexp_replace(F.lower(r), r"\s+", " "))
        return let(
            keys,
            lambda ks: F.array_join(
                F.transform(
                    F.slice(
                        F.array_distinct(F.filter(ks, lambda x: F.length(x) > 5)),
                        1,
                        P.MAX_STATUTES,
                    ),
                    lambda x: F.element_at(raw, F.array_position(ks, x).cast("int")),
                ),
                ", ",
            ),
        )

    return let(found, joined)


def _section(text: Column, pattern: str, min_words: int) -> Column:
    """The section's body, cut to size, or null where it is missing or too short."""
    body = _strip(F.regexp_extract(text, f"(?id){pattern}", 1))
    return let(
        body,
        lambda b: F.when(words(b) > min_words, F.substring(b, 1, P.SECTION_CHARS)),
    )


def facts(text: Column) -> Column:
    """Facts of the case: a facts section, else the first consideration, else lines."""
    clause = let(
        F.regexp_extract(text, f"(?is){P.FACT_CLAUSE}", 0),
        lambda m: F.when(
            m != "",
            F.substring(
                _strip(F.regexp_replace(m, rf"(?i)\A{P.FACT_OPENING}", "")),
                1,
                P.SECTION_CHARS,
            ),
        ),
    )
    long_lines = F.filter(
        F.transform(F.split(text, "\n"), _strip), lambda line: F.length(line) > 50
    )
    lines = let(
        long_lines,
        lambda ls: F.substring(
            F.when(F.size(ls) > 0, F.array_join(F.slice(ls, 3, 5), " ")).otherwise(text),
            1,
            P.SECTION_CHARS,
        ),
    )
    sections = (_section(text, p, P.MIN_FACT_WORDS) for p in P.FACT_SECTIONS)
    return F.coalesce(*sections, clause, lines)


def arguments(text: Column) -> Column:
    """Legal considerations: a section, else the first three clauses, else empty."""
    clauses = F.regexp_extract_all(text, F.lit(f"(?is){P.ARGUMENT_CLAUSE}"), F.lit(1))
    joined = F.substring(
        F.array_join(F.transform(F.slice(clauses, 1, 3), _strip), " | "),
        1,
        P.SECTION_CHARS,
    )
    sections = (_section(text, p, P.MIN_ARGUMENT_WORDS) for p in P.ARGUMENT_SECTIONS)
    return F.coalesce(*sections, joined)


def decision(disposition: Column, text: Column) -> Column:
    """Outcome label: every rule on the disposition first, then on the text."""

    def by_rules(source):
        hit = F.lit(None).cast("string")
        for label, phrases in reversed(P.DECISION_RULES):
            found = F.lit(False)
            for phrase in phrases:
                found = found | source.contains(phrase)
            hit = F.when(found, F.lit(label)).otherwise(hit)
        return hit

    return F.coalesce(
        by_rules(F.lower(F.coalesce(disposition, F.lit("")))),
        by_rules(F.lower(text)),
        F.lit(P.OTHER),
    )


def merged_label(label: Column) -> Column:
    """Three classes: granted, rejected, other; a missing label is other (VEC-2)."""
    name = F.lower(F.trim(F.coalesce(label, F.lit(""))))
    return (
        F.when(name.startswith(P.GRANTED), P.GRANTED)
        .when(name.isin(*P.REJECTED_LABELS), P.REJECTED)
        .otherwise(P.OTHER)
    )


def listed(c: Column) -> Column:
    """Number of non-blank items of a comma-separated list."""
    return F.size(F.filter(F.split(c, ","), lambda x: F.trim(x) != ""))


def preview(text: Column, chars: int = P.PREVIEW_CHARS) -> Column:
    return F.replace(F.substring(text, 1, chars), F.lit("\n"), F.lit(" "))
