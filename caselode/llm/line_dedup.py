"""Line deduplication by overlapping windows of three consecutive lines.

Windows that occur more than once in the corpus are found by their hash; every occurrence but the
first is covered, and covered lines are removed. Only hashes and positions are grouped; a window
that half of all documents share is one row after the map-side combine.
"""

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from caselode.session import staged

from . import words as w
from .common import id_and_text, map_batches, numbered_copies

WIDTH = 3
_TABLE = w.space_words()


def line_windows(data, borders, width=WIDTH):
    """(hash, text, number of the first line) of each window; a text of fewer lines is one window.

    Lines are the parts between line feeds that have a word; others are passed over.
    """
    words = w.Words(data, borders, _TABLE)
    start, end, text = words.lines()
    hashes = words.span_hashes(start, end)
    first = np.searchsorted(text, np.arange(len(borders)))
    count = np.diff(first)
    keys, at = w.windows(hashes, first, width)
    parts = [(keys, text[at], at - first[text[at]])]
    for size in range(1, width):
        # whole short texts; mixed with the size, so they meet only texts as short
        own = np.flatnonzero(count == size)
        key = np.zeros(len(own), np.uint64)
        for i in range(size):
            key = w.mixed(key + hashes[first[own] + i] + np.uint64(size))
        parts.append((key, own, np.zeros(len(own), np.int64)))
    return tuple(np.concatenate(x) for x in zip(*parts))


def line_dedup(docs: DataFrame, id_col="doc_id", text_col="text") -> DataFrame:
    """One row per row of `docs`: id, n_lines, n_removed, and the text without covered lines.

    A window's first occurrence is the one with the smallest (id, hash of the text, line). Lines are
    counted if they have a word; others stay where they are. A null text has no lines and stays null.
    The id and the text name a document: rows that repeat an id with the same text are treated alike.
    Rows with a null id are documents of their own: of those with the same text all but one are copies
    and lose every line. An empty table gives no rows. Other columns of `docs` are not read.
    """

    def measure(batch):
        for a, b, data, borders in w.pieces(batch.column("text")):
            key, text, line = line_windows(data, borders)
            own = lambda name: batch.column(name)[a:b].take(pa.array(text))  # noqa: E731, B023
            yield {"h": key.view(np.int64), "id": own("id"), "mark": own("mark"), "line": line}

    rows = id_and_text(docs, id_col, text_col).withColumn("mark", F.xxhash64("text"))
    id_type = docs.schema[id_col].dataType.simpleString()
    found = staged(map_batches(rows, measure, f"h long, id {id_type}, mark long, line int"), "line-windows")
    place = F.struct("id", "mark", "line")
    repeated = (
        found.groupBy("h").agg(F.min(place).alias("first"), F.max(place).alias("last"))
        .filter(~F.col("first").eqNullSafe(F.col("last")))
    )
    later = found.join(repeated, "h").filter(~place.eqNullSafe(F.col("first")))
    lines = later.groupBy("id", "mark").agg(F.sort_array(F.collect_set("line")).alias("lines"))
    # rows without an id are one row per text, counted, from here on; equal texts meet before the shuffle
    nameless = rows.filter(F.col("id").isNull()).groupBy("mark").agg(
        F.first("text").alias("text"), F.count("*").alias("copies")
    ).withColumn("id", F.lit(None).cast(id_type))
    rows = rows.filter(F.col("id").isNotNull()).select("id", "text", "mark").union(nameless.select("id", "text", "mark"))
    joined = rows.alias("d").join(
        lines.hint("shuffle_hash").alias("l"),
        F.col("d.id").eqNullSafe(F.col("l.id")) & (F.col("d.mark") == F.col("l.mark")), "left",
    ).select("d.id", "d.text", "l.lines")

    def cut(batch):
        column, lists = batch.column("text"), batch.column("lines")
        for a, b, data, borders in w.pieces(column):
            words = w.Words(data, borders, _TABLE)
            start, end, text = words.lines()
            first = np.searchsorted(text, np.arange(len(borders)))
            own, removed, part = lists[a:b], np.zeros(b - a, np.int64), column[a:b]
            has = np.flatnonzero(np.asarray(own.is_valid()))
            if len(has):
                texts = part.to_pylist()
                for t in has:
                    drop = np.asarray(own[t].values)
                    drop = np.unique(drop[:, None] + np.arange(WIDTH))
                    drop = drop[drop < first[t + 1] - first[t]] + first[t]
                    removed[t] = len(drop)
                    texts[t] = _without(data, borders[t], borders[t + 1], start[drop], end[drop])
                part = pa.array(texts, column.type)
            yield {"id": batch.column("id")[a:b], "n_lines": np.diff(first), "n_removed": removed, "text": part}

    schema = f"id {id_type}, n_lines long, n_removed long, text string"
    out = map_batches(joined, cut, schema)

    # what is left of a copy are its lines without words, so only they are repeated
    def without_lines(batch):
        for a, b, data, borders in w.pieces(batch.column("text")):
            words = w.Words(data, borders, _TABLE)
            start, end, text = words.lines()
            first = np.searchsorted(text, np.arange(len(borders)))
            of = lambda t: slice(first[t], first[t + 1])  # noqa: E731, B023
            left = [_without(data, borders[t], borders[t + 1], start[of(t)], end[of(t)]) for t in range(b - a)]
            has = np.asarray(batch.column("text")[a:b].is_valid())
            n = np.diff(first)
            yield {
                "id": batch.column("id")[a:b], "n_lines": n, "n_removed": n, "text": pa.array(left, mask=~has),
                "copies": batch.column("copies")[a:b],
            }

    again = nameless.filter("copies > 1").withColumn("copies", F.col("copies") - 1)
    gone = numbered_copies(map_batches(again, without_lines, schema + ", copies long"), "copies").drop("number")
    out = out.union(gone)
    return out.withColumnsRenamed({"id": id_col, "text": text_col})


def _without(data, begin, stop, start, end) -> str:
    """The text without some lines, each with the line feed after it, or the one before the last."""
    kept, at = [], begin
    for a, b in zip(start, end):
        kept.append(data[at:a].tobytes())
        at = b + 1 if b < stop else b
    text = b"".join([*kept, data[at:stop].tobytes()])
    if len(end) and end[-1] == stop and text.endswith(b"\n"):
        text = text[:-1]
    return text.decode()
