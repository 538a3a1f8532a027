"""Benchmark decontamination by a broadcast set of the benchmark's word windows.

Every run of 13 words of every document is looked up by its hash; a hit is verified word by word
before it counts. The benchmark is taken in blocks of bounded size, nearly always one, and one after
the other, so neither the driver, a broadcast nor a plan grows with it; each block is one more scan of the documents.
"""

import hashlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from caselode.session import own_folder, staged

from . import words as w
from .common import id_and_text, map_batches

WINDOW = 13
#: A document is contaminated from this share of hit words on: one in 20.
HIT_SHARE = 20
#: Bytes of benchmark text whose windows are broadcast at once: about 50 MB as hashes and words.
BLOCK_BYTES = 4 << 20

_TABLE, _FOLD = w.letter_words(), w.lower_case()


@dataclass
class Windows:
    """Distinct windows of some benchmark items: sorted hashes, their words, and their items."""

    hashes: np.ndarray
    words: list  # of each hash: (words joined by spaces, item positions); several if hashes collide
    widths: list
    items: list
    seen: np.ndarray  # for the upper bits of a hash, whether any window has them

    def candidates(self, hashes):
        """Positions in `hashes` that may be windows, and their places in `self.hashes`."""
        shift = np.uint64(64 - int(self.seen.size).bit_length() + 1)
        at = np.flatnonzero(self.seen[hashes >> shift])
        place = np.searchsorted(self.hashes, hashes[at])
        place[place == len(self.hashes)] = 0
        same = self.hashes[place] == hashes[at]
        return at[same], place[same]


def benchmark_windows(items, texts, width=WINDOW) -> Windows:
    """Windows of `width` words; an item of fewer words, but not none, is one window."""
    data, borders = w.text_bytes(pa.array(texts, pa.large_string()))
    words = w.Words(data, borders, _TABLE, _FOLD)
    hashes = words.hashes()
    found, widths = {}, set()
    for i, (first, count) in enumerate(zip(words.first, words.count)):
        if not count:
            continue
        size = min(width, int(count))
        widths.add(size)
        own = hashes[first : first + count]
        keys, at = w.windows(own, np.array([0, count]), size)
        for key, a in zip(keys.tolist(), at.tolist()):
            text = joined(words, first + a, size)
            found.setdefault(key, {}).setdefault(text, set()).add(i)
    order = sorted(found)
    keys = np.array(order, np.uint64)
    bits = max(16, (64 * len(order)).bit_length())
    seen = np.zeros(1 << bits, bool)
    seen[keys >> np.uint64(64 - bits)] = True
    texts = [[(t, tuple(sorted(s))) for t, s in found[k].items()] for k in order]
    return Windows(keys, texts, sorted(widths), [str(i) for i in items], seen)


def joined(words, first, size) -> bytes:
    start, end = words.start[first : first + size], words.end[first : first + size]
    return b" ".join(words.data[a:b].tobytes() for a, b in zip(start, end))


def scan(windows: Windows, data, borders):
    """(words, mask of hit words, for each text the positions of the items found in it)."""
    words = w.Words(data, borders, _TABLE, _FOLD)
    hashes = words.hashes()
    n = len(hashes)
    steps = np.zeros(n + 1, np.int64)
    items = [set() for _ in words.count]
    if len(windows.hashes):
        for width in windows.widths:
            keys, at = w.windows(hashes, words.first, width)
            where, place = windows.candidates(keys)
            first = at[where]
            texts = np.searchsorted(words.first, first, "right") - 1
            for f, p, t in zip(first.tolist(), place.tolist(), texts.tolist()):
                known = windows.words[p]
                own = joined(words, f, width)
                for text, of in known:
                    if text == own:
                        steps[f] += 1
                        steps[f + width] -= 1
                        items[t].update(of)
    return words, np.cumsum(steps[:-1]) > 0, items


def items_digest(items) -> str:
    return hashlib.sha256(",".join(sorted(items)).encode()).hexdigest()


def _n_blocks(bench: DataFrame, text_col) -> int:
    total = bench.agg(F.sum(F.octet_length(F.col(f"`{text_col}`")))).first()[0] or 0
    return -(-total // BLOCK_BYTES) or 1


def _blocks(bench: DataFrame, id_col, text_col):
    """The benchmark's rows in lists of bounded size, each read when it is asked for."""
    n, rows = _n_blocks(bench, text_col), id_and_text(bench, id_col, text_col)
    if n > 1:  # written in order of blocks, so that reading one passes over the others
        block = F.pmod(F.xxhash64("id", "text"), F.lit(n))
        rows = staged(rows.withColumn("block", block).repartitionByRange("block").sortWithinPartitions("block"), "benchmark")
    for i in range(n):
        part = rows if n == 1 else rows.filter(F.col("block") == i)
        yield [(r["id"], r["text"]) for r in part.orderBy("id", "text").collect()]


def _shared(docs: DataFrame, block):
    """The windows of a block, broadcast."""
    windows = benchmark_windows([i for i, _ in block], [t for _, t in block], WINDOW)
    return docs.sparkSession.sparkContext.broadcast(windows)


def _scanned(docs: DataFrame, shared) -> DataFrame:
    """(id, mark, n_words, hit_from, hit_to, items) of every row; hits are runs of word numbers."""

    def measure(batch):
        known = shared.value
        for a, b, data, borders in w.pieces(batch.column("text")):
            words, hit, items = scan(known, data, borders)
            edge = np.diff(np.concatenate([[0], hit.view(np.int8), [0]]))
            inner = np.unique(words.first)  # runs end with their text
            start = np.union1d(np.flatnonzero(edge == 1), inner[inner < len(hit)][hit[inner[inner < len(hit)]]])
            stop = np.union1d(np.flatnonzero(edge == -1), inner[inner > 0][hit[inner[inner > 0] - 1]])
            text = np.searchsorted(words.first, start, "right") - 1
            cut = np.searchsorted(text, np.arange(b - a + 1))
            lists = lambda x: pa.ListArray.from_arrays(pa.array(cut, pa.int32()), pa.array(x - words.first[text], pa.int32()))
            yield {
                "id": batch.column("id")[a:b],
                "mark": batch.column("mark")[a:b],
                "n_words": words.count,
                "hit_from": lists(start),
                "hit_to": lists(stop),
                "items": [[known.items[i] for i in sorted(s)] for s in items],
            }

    id_type = docs.schema["id"].dataType.simpleString()
    schema = (
        f"id {id_type}, mark long, n_words long, hit_from array<int>, hit_to array<int>, items array<string>"
    )
    return map_batches(docs.select("id", F.xxhash64("text").alias("mark"), "text"), measure, schema)


def scan_benchmark(
    docs: DataFrame, bench: DataFrame, id_col="doc_id", text_col="text", item_col="item_id", item_text_col="text"
) -> DataFrame:
    """One row per row of `docs`: id, n_words, n_hit, items (sorted strings), hit_from, hit_to, contaminated.

    hit_from and hit_to are the runs of hit words, as word numbers with an exclusive end.
    A null or empty text has no words and is clean; so is every document against an empty
    benchmark. Null or wordless items have no windows. An item that is listed twice counts once
    if its id is the same. Rows of `docs` that repeat give the same row each. Other columns are not read.
    """
    rows = id_and_text(docs, id_col, text_col)
    blocks = _blocks(bench, item_col, item_text_col)
    if _n_blocks(bench, item_text_col) == 1:
        out = _scanned(rows, _shared(rows, next(blocks)))
    else:
        out = _in_turn(rows, blocks)
    n_hit = F.aggregate(
        F.zip_with("hit_to", "hit_from", lambda a, b: (a - b).cast("long")), F.lit(0).cast("long"), lambda x, y: x + y
    )
    return (
        out.withColumn("n_hit", n_hit)
        .withColumn("items", F.array_sort(F.array_distinct("items")))
        .select(
            F.col("id").alias(id_col), "n_words", "n_hit", "items", "hit_from", "hit_to",
            ((F.col("n_hit") > 0) & (HIT_SHARE * F.col("n_hit") >= F.col("n_words"))).alias("contaminated"),
        )
    )


def _in_turn(rows: DataFrame, blocks) -> DataFrame:
    """As `_scanned`, for the benchmark's blocks one after the other, and their hits put together once.

    The hits of a block are written before the next block is read, so one block is in the driver and in the
    broadcast at a time, and no plan holds more than one scan. Rows of one id and text are alike.
    """
    spark, folder, base = rows.sparkSession, own_folder(rows.sparkSession, "hits"), None
    for i, block in enumerate(blocks):
        shared = _shared(rows, block)
        found = _scanned(rows, shared)
        if base is None:
            found = base = staged(found, "scanned")
        hits = found.filter(F.size("items") > 0).withColumn("block", F.lit(i))
        hits.write.mode("append").parquet(folder)
        shared.destroy()
    once = spark.read.schema(hits.schema).parquet(folder).dropDuplicates(["id", "mark", "block"])
    every = [F.flatten(F.collect_list(c)).alias(c) for c in ("hit_from", "hit_to", "items")]  # a list per block at most
    together = once.groupBy("id", "mark").agg(*every)

    def merge(batch):
        runs = [_merged(a.values, b.values) for a, b in zip(batch.column("hit_from"), batch.column("hit_to"))]
        yield {c: batch.column(c) for c in ("id", "mark", "items")} | {
            "hit_from": [a for a, _ in runs], "hit_to": [b for _, b in runs]
        }

    id_type = rows.schema["id"].dataType.simpleString()
    schema = f"id {id_type}, mark long, hit_from array<int>, hit_to array<int>, items array<string>"
    merged = map_batches(together, merge, schema)
    filled = [
        F.coalesce(f"m.{c}", F.array().cast(t)).alias(c)
        for c, t in (("hit_from", "array<int>"), ("hit_to", "array<int>"), ("items", "array<string>"))
    ]
    alike = F.col("d.id").eqNullSafe(F.col("m.id")) & F.col("d.mark").eqNullSafe(F.col("m.mark"))
    some = base.filter("n_words > 0").select("id", "mark", "n_words").alias("d").join(merged.alias("m"), alike, "left")
    columns = ["id", "mark", "n_words", "hit_from", "hit_to", "items"]
    return some.select("d.id", "d.mark", "n_words", *filled).union(base.filter("n_words = 0").select(*columns))


def _merged(start, end):
    """Runs in order, with those joined that overlap or touch."""
    start, end = np.asarray(start), np.asarray(end)
    order = np.argsort(start, kind="stable")
    start, reach = start[order], np.maximum.accumulate(end[order])
    apart = start[1:] > reach[:-1]
    return start[np.append(True, apart)], reach[np.append(apart, True)]


def decontaminate(
    docs: DataFrame, bench: DataFrame, remove="documents", id_col="doc_id", text_col="text",
    item_col="item_id", item_text_col="text",
) -> DataFrame:
    """`docs` with all its columns, without contaminated documents, or without the hit spans.

    remove="spans" keeps every row and cuts the hit words, from the first byte of a run's first
    word to the last byte of its last; hits are found in the whole text, and cut once, however many
    blocks the benchmark has. Nulls stay null; rows keep their other columns as they are.
    """
    if remove not in ("documents", "spans"):
        raise ValueError("remove is 'documents' or 'spans'")
    if _n_blocks(bench, item_text_col) == 1:
        shared = _shared(docs, next(_blocks(bench, item_col, item_text_col)))
        return (_without_spans if remove == "spans" else _without_documents)(docs, shared, text_col)
    if remove == "spans":
        return _without_found_spans(docs, bench, text_col, item_col, item_text_col)
    bad = scan_benchmark(
        docs.select(F.xxhash64(text_col).alias("_mark"), F.col(f"`{text_col}`").alias("text")), bench, "_mark", "text",
        item_col, item_text_col,
    ).filter("contaminated").select("_mark").distinct()
    return docs.join(bad, F.xxhash64(docs[text_col]) == bad["_mark"], "left_anti")


def _without_documents(docs, shared, text_col):
    def run(batches):
        known = shared.value
        for batch in batches:
            keep = np.ones(batch.num_rows, bool)
            for a, b, data, borders in w.pieces(batch.column(text_col)):
                words, hit, _ = scan(known, data, borders)
                n_hit = w.per_text(hit, words.first)
                keep[a:b] = (n_hit == 0) | (HIT_SHARE * n_hit < words.count)
            yield batch.filter(pa.array(keep))

    return docs.mapInArrow(run, docs.schema)


def _without_spans(docs, shared, text_col):
    def run(batches):
        known = shared.value
        for batch in batches:
            column = batch.column(text_col)
            new = {}
            for a, b, data, borders in w.pieces(column):
                words, hit, items = scan(known, data, borders)
                for t, found in enumerate(items):
                    if found:
                        first, last = words.first[t], words.first[t + 1]
                        edge = np.diff(np.concatenate([[0], hit[first:last].view(np.int8), [0]]))
                        runs = np.flatnonzero(edge == 1) + first, np.flatnonzero(edge == -1) + first
                        new[a + t] = _cut(words, data, borders[t], borders[t + 1], *runs)
            if new:
                texts = column.to_pylist()
                for i, text in new.items():
                    texts[i] = text
                batch = batch.set_column(batch.schema.get_field_index(text_col), text_col, pa.array(texts, column.type))
            yield batch

    return docs.mapInArrow(run, docs.schema)


def _cut(words, data, begin, stop, start, end) -> str:
    """A text without runs of words, from the first byte of a run's first to the last of its last."""
    out, at = [], begin
    for x, y in zip(start, end):
        out.append(data[at : words.start[x]].tobytes())
        at = words.end[y - 1]
    out.append(data[at:stop].tobytes())
    return b"".join(out).decode()


def _without_found_spans(docs, bench, text_col, item_col, item_text_col):
    """The hits of all blocks on the texts as they are, brought back by the hash of the text."""
    names = {c: f"c{i}" for i, c in enumerate(docs.columns)}
    text = names[text_col]
    packed = docs.select(*[F.col(f"`{c}`").alias(x) for c, x in names.items()])
    marked = packed.select(F.xxhash64(text).alias("mark"), F.col(text).alias("text"))
    found = scan_benchmark(marked, bench, "mark", "text", item_col, item_text_col).filter("n_hit > 0")
    found = found.select("mark", "hit_from", "hit_to").dropDuplicates(["mark"])
    joined = packed.join(found, F.xxhash64(text) == F.col("mark"), "left").drop("mark")

    def run(batches):
        for batch in batches:
            column, new = batch.column(text), {}
            start, end = batch.column("hit_from"), batch.column("hit_to")
            for a, b, data, borders in w.pieces(column):
                has = np.flatnonzero(np.asarray(start[a:b].is_valid()))
                words = w.Words(data, borders, _TABLE, _FOLD) if len(has) else None
                for t in has.tolist():
                    runs = (np.asarray(x[a + t].values) + words.first[t] for x in (start, end))
                    new[a + t] = _cut(words, data, borders[t], borders[t + 1], *runs)
            batch = batch.select(list(names.values()))
            if new:
                texts = column.to_pylist()
                for i, x in new.items():
                    texts[i] = x
                batch = batch.set_column(batch.schema.get_field_index(text), text, pa.array(texts, column.type))
            yield batch

    out = joined.mapInArrow(run, packed.schema)
    return out.select(*[F.col(x).alias(c) for c, x in names.items()])
