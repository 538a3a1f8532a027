"""Reading links, headings and labelled table cells from HTML (WEB-1 .. WEB-6)."""

import json
from html.entities import html5

from pyspark.sql import Column, functions as F

from caselode import profile as P
from caselode.functions.text import let, strip

_REFERENCE = r"&(?:#[0-9]+;?|#[xX][0-9a-fA-F]+;?|[A-Za-z][A-Za-z0-9]*;?)"
_PIECES = rf"{_REFERENCE}|[^&]+|&"
# The names of the standard's list, as Python's library has it; those without ";" are the old ones.
_NAMED = json.dumps(html5)
# Numbers 128 to 159 stand for what Windows-1252 has there.
_WINDOWS = json.dumps({str(b): bytes([b]).decode("cp1252", "ignore") for b in range(0x80, 0xA0) if bytes([b]).decode("cp1252", "ignore")})
_HIDDEN = r"(?is)<!--.*?-->|<script\b.*?</script\s*>|<style\b.*?</style\s*>"
_ANCHOR = r"""(?is)<a\s(?:[^>]*?\s)?href\s*=\s*["']([^"']*)["']"""
_TABLE_REST = r"""(?is)<table\b[^>]*\bclass\s*=\s*["'](?:[^"']*\s)?table(?:\s[^"']*)?["'][^>]*>(.*)"""


def _number(digits: Column, base: int) -> Column:
    """The character of a numeric reference; what is no character is U+FFFD."""
    short = F.regexp_replace(digits, "^0+", "")
    code = F.when(F.length(short) > 7, F.lit(0x110000)).otherwise(F.conv(F.concat(F.lit("0"), short), base, 10).cast("int"))
    odd = (code == 0) | (code > 0x10FFFF) | code.between(0xD800, 0xDFFF)
    plain = F.decode(F.unhex(F.lpad(F.hex(F.when(odd, F.lit(0xFFFD)).otherwise(code).cast("long")), 8, "0")), "UTF-32")
    return F.coalesce(F.try_element_at(F.from_json(F.lit(_WINDOWS), "map<string,string>"), code.cast("string")), plain)


def _character(reference: Column) -> Column:
    name = F.regexp_extract(reference, "^&#[xX]([0-9a-fA-F]+);?$", 1)
    digits = F.regexp_extract(reference, "^&#([0-9]+);?$", 1)
    named = F.try_element_at(F.from_json(F.lit(_NAMED), "map<string,string>"), F.substring(reference, 2, 64))
    return (
        F.when(name != "", _number(name, 16)).when(digits != "", _number(digits, 10)).otherwise(F.coalesce(named, reference))
    )


def resolve(c: Column) -> Column:
    """The text with its character references resolved: numbers, and all names of the standard; others stay.

    An old name without its ";" counts where no letter or digit follows.
    """
    pieces = F.regexp_extract_all(c, F.lit(_PIECES), F.lit(0))
    resolved = F.transform(pieces, lambda x: F.when(x.startswith("&") & (F.length(x) > 1), _character(x)).otherwise(x))
    return F.when(c.contains("&"), F.array_join(resolved, "")).otherwise(c)


def visible(html: Column) -> Column:
    return F.regexp_replace(html, _HIDDEN, "")


def links(html: Column, pattern: str) -> Column:
    """Targets of all links whose target matches ``pattern``, in document order."""
    targets = F.regexp_extract_all(visible(html), F.lit(_ANCHOR), F.lit(1))
    return F.filter(F.transform(targets, resolve), lambda t: t.rlike(pattern))


def first_link(html: Column, pattern: str = P.DOCUMENT_LINK) -> Column:
    return F.coalesce(F.get(links(html, pattern), F.lit(0)), F.lit(""))


def _pieces(fragment: Column) -> Column:
    return F.transform(F.split(fragment, r"<[^>]*>"), resolve)


def stripped_text(fragment: Column) -> Column:
    """Text of a fragment: every piece between tags stripped, then joined."""
    return F.array_join(F.transform(_pieces(fragment), strip), "")


def heading(html: Column, tag: str) -> Column:
    return stripped_text(F.regexp_extract(html, rf"(?is)<{tag}\b[^>]*>(.*?)</{tag}\s*>", 1))


def _parts(html: Column, tags: str) -> Column:
    """(text, tag) in order: what stands before each start or end tag of some names, and the tag; the last has none."""
    tag = rf"(?is)</?(?:{tags})\b[^>]*>$"
    pieces = F.regexp_extract_all(html, F.lit(rf"(?is).*?(?:</?(?:{tags})\b[^>]*>|\z)"), F.lit(0))
    return F.transform(
        pieces, lambda p: F.struct(F.regexp_replace(p, tag, "").alias("text"), F.regexp_extract(p, tag, 0).alias("tag"))
    )


def _joined(parts: Column, start: Column, end: Column) -> Column:
    """Parts start to end, numbered from 1, as they stood; of the last one the text only."""
    inside = F.transform(F.slice(parts, start, F.greatest(end - start, F.lit(0))), lambda p: F.concat(p["text"], p["tag"]))
    return F.concat(F.array_join(inside, ""), F.coalesce(F.get(parts, end - 1)["text"], F.lit("")))


def _depths(parts: Column) -> Column:
    """Depth in tables after each part; a running sum, carried along in the last entry."""

    def step(tag):
        return F.when(tag.rlike(r"(?i)^<table\b"), 1).when(tag.rlike(r"(?i)^</table\b"), -1).otherwise(0)

    walked = F.aggregate(parts, F.array(F.lit(0)), lambda out, p: F.concat(out, F.array(F.element_at(out, -1) + step(p["tag"]))))
    return F.slice(walked, F.lit(2), F.greatest(F.size(walked) - 1, F.lit(0)))


def detail_table(html: Column) -> Column:
    """Inner HTML of the first table of class "table", up to its own end tag; empty when there is none.

    Tables inside it are part of it.  A table without an end tag reaches to the end.
    """

    def cut(parts):
        closed = F.array_position(F.transform(_depths(parts), lambda d: d < 0), True).cast("int")
        return _joined(parts, F.lit(1), F.when(closed > 0, closed).otherwise(F.size(parts)))

    return let(_parts(F.regexp_extract(visible(html), _TABLE_REST, 1), "table"), cut)


def without_first(html: Column, tag: str) -> Column:
    """The fragment without its first ``tag`` element; the text around it stays."""
    return F.regexp_replace(html, rf"(?is)\A(.*?)<{tag}\b[^>]*>.*?</{tag}\s*>", "$1")


def cells(table: Column) -> Column:
    """Inner HTML of the cells, in the order in which they begin; cells of inner tables come after the cell around them.

    A cell ends with its end tag, with the next cell or row of its own table, or with that table.
    """

    def inside(parts, depths):
        begins = F.filter(
            F.transform(parts, lambda p, i: F.when(p["tag"].rlike(r"(?i)^<td\b"), i)), lambda i: i.isNotNull()
        )
        marks = F.zip_with(
            parts, depths, lambda p, d: F.struct(p["tag"].rlike(r"(?i)^</?t[dhr]\b").alias("edge"), d.alias("depth"))
        )

        def content(i):
            depth = F.get(depths, i)
            ends = F.transform(
                F.slice(marks, i + 2, F.size(marks)), lambda m: (m["edge"] & (m["depth"] == depth)) | (m["depth"] < depth)
            )
            end = F.array_position(ends, True).cast("int")
            return _joined(parts, i + 2, F.when(end > 0, i + 1 + end).otherwise(F.size(parts)))

        return F.transform(begins, content)

    return let(_parts(table, "td|th|tr|table"), lambda parts: let(_depths(parts), lambda depths: inside(parts, depths)))


def read_cells(table: Column) -> Column:
    """(text, value) of the cells: their text, and the same with every piece between tags stripped."""

    def read(cell):
        return let(_pieces(cell), lambda p: F.struct(
            F.array_join(p, "").alias("text"), F.array_join(F.transform(p, strip), "").alias("value")
        ))

    return F.transform(cells(table), read)


def field(read: Column, label: str) -> Column:
    """Value of the cell after the first cell whose text contains ``label``, else empty.

    Containment is meant: "Amar" also hits an earlier "Amar Lainnya" cell.
    """
    at = F.array_position(F.transform(read, lambda x: x["text"].contains(label)), F.lit(True)).cast("int")
    return F.when(at > 0, F.coalesce(F.get(read, at)["value"], F.lit(""))).otherwise("")


def fields(read: Column, wanted=P.PAGE_FIELDS) -> list[Column]:
    return [field(read, label).alias(name) for name, label in wanted]


def case_id(url: Column, position: Column) -> Column:
    """Stable id from the address, else from the position in the listing (WEB-4)."""
    slug = F.regexp_extract(url, P.DETAIL_SLUG, 1)
    number = position.cast("string")
    padded = F.when(F.length(number) < 3, F.lpad(number, 3, "0")).otherwise(number)
    return F.concat(F.lit("case_"), F.when(slug != "", F.right(slug, F.lit(40))).otherwise(padded))
