"""N-gram Jaccard join by T-occurrence search (DivideSkip).

Two documents link when their sets of word shingles have a Jaccard similarity of at least 85 %. For
a document with n shingles a partner shares at least T = ceil(0.85 n) of them, so it occurs in T of
the document's n inverted lists. Divided as DivideSkip does: of the lists of the n - T + 1 rarest
shingles (the short ones) at least one must hold the partner, the T - 1 longest are only probed.

1. Short lists. Shingles are put in one order for all, frequent ones last; every document enters
   the lists of its first n - T + 1. Lists with one kind of document are dropped.
2. Stars. In every list the documents of like size are paired with one of them only, so a group of m
   near copies gives m pairs. Pairs are searched, and links joined to components.
3. Rest. Documents of one list that are still in different components are compared by 256 bits
   inside the task; only pairs which these cannot rule out leave it, and are searched.
4. Search. A query document's shingles become inverted lists over its candidates; the short lists are
   merged, candidates with T - L occurrences are probed in the L long lists, and those that reach
   the overlap are links. Sets are read again from the texts for the documents in question only.

Documents with equal sets are one class, known by a 64-bit hash of the set. The result is exact but for
collisions of 64-bit hashes.
"""

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from caselode.session import staged

from . import words as w
from .common import id_and_text, map_batches
from .components import components

WIDTH = 4
PERCENT = 85
#: Shingles that are counted together; one that this many of their documents have is passed on, and is
#: frequent from the third number on.
COUNTED, SEEN_IN_BATCH, FREQUENT = 2_000_000, 2, 16
#: The most frequent shingles go last in the order. The order decides on cost only, never on the
#: result, so their table has a fixed size: 2**17 hashes, one megabyte.
ORDERED = 1 << 17
#: Parity bits of a set: a few that travel with every list entry, and many for pairs.
BITS, WIDE_BITS = 256, 2048
#: Documents of one list that are compared with each other in one go; longer lists go in blocks.
BLOCK = 4096
#: Rounds of pairs with one document of a list, before the rest is compared.
STAR_ROUNDS = 1
#: Candidates of one query that are searched together.
CANDIDATES = 32
#: Bits of the filter that picks the documents to read again: 2 MB whatever the corpus.
PICK_BITS = 1 << 24

_TABLE, _FOLD = w.space_words(), w.lower_case()


def shingle_sets(data, borders, width=WIDTH):
    """(hashes, first): distinct shingles of each text in order of hash, and where each text's begin.

    A text of fewer words, but not none, has its whole sequence as one shingle.
    """
    words = w.Words(data, borders, _TABLE, _FOLD)
    hashes = words.hashes()
    keys, at = w.windows(hashes, words.first, width)
    texts = np.searchsorted(words.first, at, "right") - 1
    for size in range(1, width):
        own = np.flatnonzero(words.count == size)
        if len(own):
            short = np.zeros(len(own), np.uint64)
            for i in range(size):
                short = w.mixed(short + hashes[words.first[own] + i] + np.uint64(size))
            keys, texts = np.concatenate([keys, short]), np.concatenate([texts, own])
    order = np.argsort(keys)
    order = order[np.argsort(texts[order].astype(np.uint16 if len(borders) < 1 << 16 else np.int64), kind="stable")]
    keys, texts = keys[order], texts[order]
    new = np.ones(len(keys), bool)
    new[1:] = (keys[1:] != keys[:-1]) | (texts[1:] != texts[:-1])
    keys, texts = keys[new], texts[new]
    return keys, np.searchsorted(texts, np.arange(len(borders)))


def set_class(keys, first) -> np.ndarray:
    """A hash of each text's whole set."""
    total = np.zeros(len(keys) + 1, np.uint64)
    np.cumsum(w.mixed(keys ^ np.uint64(w.WORD_BASE)), out=total[1:])
    size = np.diff(first).astype(np.uint64)
    return w.mixed((total[first[1:]] - total[first[:-1]]) + size * np.uint64(w.BYTE_BASE)).view(np.int64)


def least_overlap(n):
    """Shingles that a partner of a set of n shares at least."""
    return (PERCENT * n + 99) // 100


def overlap_needed(a, b):
    """Common shingles from which sets of sizes a and b link: 100 i >= 85 (a + b - i)."""
    return -(-PERCENT * (a + b) // (100 + PERCENT))


def short_lists(keys, first, frequent, ranks):
    """(shingles, first) of each text's n - T + 1 rarest shingles; `frequent` is sorted, with ranks."""
    n = np.diff(first)
    texts = np.repeat(np.arange(len(n)), n)
    rank = np.zeros(len(keys), np.int64)
    if len(frequent):
        place = np.minimum(np.searchsorted(frequent, keys), len(frequent) - 1)
        known = frequent[place] == keys
        rank[known] = ranks[place[known]]
    order = np.argsort(texts * (len(frequent) + 1) + rank, kind="stable")
    take = np.where(n > 0, n - least_overlap(n) + 1, 0)
    chosen = np.arange(len(keys)) - np.repeat(first[:-1], n) < np.repeat(take, n)
    return keys[order][chosen], np.concatenate([[0], np.cumsum(take)])


def parity_bits(keys, first, bits) -> np.ndarray:
    """Bits of each text, as rows of bytes: the parity of its shingles by hash. Sets that differ in d
    shingles differ in d bits at most."""
    n = len(first) - 1
    texts = np.repeat(np.arange(n), np.diff(first))
    place = texts * bits + (w.mixed(keys ^ np.uint64(w.BYTE_BASE)) & np.uint64(bits - 1)).astype(np.int64)
    odd = np.bincount(place, minlength=n * bits) & 1
    return np.packbits(odd.astype(np.uint8).reshape(n, bits), axis=1)


def _binary(rows: np.ndarray) -> pa.Array:
    kind = pa.binary(rows.shape[1])
    return pa.FixedSizeBinaryArray.from_buffers(kind, len(rows), [None, pa.py_buffer(rows.tobytes())]).cast(pa.binary())


def _frequent(rows: DataFrame):
    """Sorted hashes of the most frequent shingles, and their places from the rarest to the most frequent."""

    def count(batch):
        held, n = [], 0
        for _, stop, data, borders in w.pieces(batch.column("text")):
            held.append(shingle_sets(data, borders)[0])
            n += len(held[-1])
            if n >= COUNTED or stop == batch.num_rows:
                yield counted_keys(np.concatenate(held))
                held, n = [], 0

    def counted_keys(keys):
        keys.sort()
        first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
        n = np.diff(first, append=len(keys))
        often = n >= SEEN_IN_BATCH
        return {"key": keys[first[often]].view(np.int64), "n": n[often]}

    counted = map_batches(rows.select("text"), count, "key long, n long").groupBy("key").agg(F.sum("n").alias("n"))
    top = counted.filter(F.col("n") >= FREQUENT).orderBy(F.desc("n"), "key").limit(ORDERED).collect()
    keys = np.array([r["key"] for r in top], np.int64).view(np.uint64)
    order = np.argsort(keys)
    return keys[order], (len(keys) - np.arange(len(keys)))[order]


def _classed(rows: DataFrame) -> DataFrame:
    """(id, mark, text_mark, n, c): set size and class of every row."""

    def classed(batch):
        for a, b, data, borders in w.pieces(batch.column("text")):
            keys, first = shingle_sets(data, borders)
            own = {k: batch.column(k)[a:b] for k in ("id", "mark", "text_mark")}
            yield own | {"n": np.diff(first), "c": set_class(keys, first)}

    id_type = rows.schema["id"].dataType.simpleString()
    schema = f"id {id_type}, mark long, text_mark long, n int, c long"
    return map_batches(_marked(rows).withColumn("text_mark", F.xxhash64("text")), classed, schema)


def _described(rows: DataFrame, frequent) -> DataFrame:
    """(c, n, shingles, bits, wide): class, size, short-list shingles and bits of every row.

    These are ten times a row of ``_classed``. They are found in a reading of their own, so only those of one row
    per class are written.
    """
    shared = rows.sparkSession.sparkContext.broadcast(frequent)

    def describe(batch):
        known, ranks = shared.value
        for _, _, data, borders in w.pieces(batch.column("text")):
            keys, first = shingle_sets(data, borders)
            short, cut = short_lists(keys, first, known, ranks)
            yield {
                "c": set_class(keys, first),
                "n": np.diff(first),
                "shingles": pa.ListArray.from_arrays(pa.array(cut, pa.int32()), pa.array(short.view(np.int64))),
                "bits": _binary(parity_bits(keys, first, BITS)),
                "wide": _binary(parity_bits(keys, first, WIDE_BITS)),
            }

    return map_batches(rows.select("text"), describe, "c long, n int, shingles array<long>, bits binary, wide binary")


def _marked(rows: DataFrame) -> DataFrame:
    return rows.withColumn("mark", F.xxhash64("id"))


def _lists(sets: DataFrame) -> DataFrame:
    """(shingle, c, n, p) of the short lists with two classes or more; p is the shingle's place in the class's order.

    `sets` has one row per class, so copies are in no list; a long list is one row until the join, which can be split."""
    rows = sets.select("c", "n", F.posexplode("shingles").alias("p", "shingle"))
    ends = rows.groupBy("shingle").agg(F.min("c").alias("one"), F.max("c").alias("other"))
    return rows.join(_grows(ends.filter("one != other").select("shingle")), "shingle").select("shingle", "c", "n", "p")


def _most_different(n, m):
    """How many shingles may be in one set only if sets of n and m link: 15 / 185 of the sum."""
    return (n + m) * (100 - PERCENT) / (100 + PERCENT)


def _may_link(n, m, bits_n, bits_m) -> np.ndarray:
    """Whether size and bits leave the link of two sets open, for arrays of pairs."""
    n, m = n.astype(np.int64), m.astype(np.int64)
    differ = np.bitwise_count(bits_n ^ bits_m).sum(1, dtype=np.int64)
    return (np.minimum(n, m) * 100 >= np.maximum(n, m) * PERCENT) & (
        differ * (100 + PERCENT) <= (n + m) * (100 - PERCENT)
    )


def _bit_rows(column) -> np.ndarray:
    rows = column.to_pylist()
    return np.frombuffer(b"".join(rows), np.uint64).reshape(len(rows), -1)


def _picked(spark, slots: DataFrame):
    """A broadcast set of PICK_BITS bits with those of the column `slot`."""
    packed = slots.select(F.floor(F.col("slot") / 64).alias("word"), F.pmod("slot", F.lit(64)).cast("int").alias("bit"))
    packed = packed.groupBy("word").agg(F.bit_or(F.expr("shiftleft(1L, bit)")).alias("bits"))
    pick = np.zeros(PICK_BITS // 64, np.int64)
    for r in packed.collect():  # PICK_BITS / 64 rows at most
        pick[r["word"]] = r["bits"]
    return spark.sparkContext.broadcast(pick.view(np.uint64))


def _has(pick, slot):
    return ((pick[slot >> 6] >> (slot & 63).astype(np.uint64)) & np.uint64(1)).astype(bool)


def _open_pairs(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs (q, c) that sizes and the many bits do not rule out.

    Sets that are in no pair are sorted out by a filter of fixed size before they are joined.
    """
    pairs = staged(pairs, "all-pairs")
    ends = pairs.select("c").union(pairs.select("q"))
    shared = _picked(pairs.sparkSession, ends.select(F.pmod("c", F.lit(PICK_BITS)).alias("slot")))

    def in_pairs(batches):
        for x in batches:
            yield x.filter(pa.array(_has(shared.value, x["c"].to_numpy() & (PICK_BITS - 1))))

    def near(batches):
        for x in batches:
            if x.num_rows:
                ok = _may_link(x["n"].to_numpy(), x["nq"].to_numpy(), _bit_rows(x["wide"]), _bit_rows(x["wide_q"]))
                yield x.select(["q", "c"]).filter(pa.array(ok))

    a = sets.select("c", "n", "wide").mapInArrow(in_pairs, "c long, n int, wide binary")
    b = a.select(F.col("c").alias("q"), F.col("n").alias("nq"), F.col("wide").alias("wide_q"))
    return _grows(pairs).join(_grows(a), "c").join(_grows(b), "q").mapInArrow(near, "q long, c long")


def _grows(df: DataFrame) -> DataFrame:
    """A side that grows with the corpus: joined by sorting, at small sizes too."""
    return df.hint("merge")


def _with_roots(lists: DataFrame, roots: DataFrame | None) -> DataFrame:
    if roots is None:
        return lists.withColumn("root", F.col("c"))
    found = lists.join(_grows(roots.withColumnRenamed("node", "c")), "c", "left")
    return found.withColumn("root", F.coalesce("root", "c"))


def _star_pairs(lists: DataFrame, roots: DataFrame | None) -> DataFrame:
    """(q, c): in every list, documents of like size with one of another component.

    That is the one with the fewest shingles before the list's, all rarer: of near copies of a text, the
    least changed. Once there are components, it is chosen from the one with the smallest root.
    """
    rows = _with_roots(lists, roots).withColumn("size", F.floor(F.log("n") / F.lit(-math.log(PERCENT / 100))))
    order = F.struct("p", "n", "c", "root") if roots is None else F.struct("root", "p", "n", "c")
    first = rows.groupBy("shingle", "size").agg(
        F.min(order).alias("q"), F.min("root").alias("one"), F.max("root").alias("other")
    ).filter("one != other")
    pairs = rows.join(_grows(first), ["shingle", "size"]).filter(F.col("q.root") != F.col("root"))
    return pairs.select(F.col("q.c").alias("q"), "c").distinct()


def _rest_pairs(lists: DataFrame, bits: DataFrame, roots: DataFrame) -> DataFrame:
    """(q, c): documents of one list in different components which size, places and bits do not rule out.

    At the first shingle that two documents share, all before it are in one set only. So a link shows
    in a list where the two places add up to no more than may differ; other lists need not look.
    """
    # a place less the document's own share of what may differ; of a link's two, the sum is 0 at most
    beyond = F.col("p") - _most_different(F.col("n"), 0)
    rows = _with_roots(lists, roots).withColumn("beyond", beyond)
    kinds = rows.groupBy("shingle").agg(
        F.min("root").alias("one"), F.max("root").alias("other"), F.count("*").alias("m"), F.min("beyond").alias("least")
    ).filter("one != other")
    blocks = F.ceil(F.col("m") / BLOCK).cast("int").alias("blocks")
    rows = rows.join(_grows(kinds.select("shingle", "least", blocks)), "shingle").filter("beyond + least <= 1e-6")
    # a list of several blocks meets itself block by block; each pair of blocks is one group
    rows = rows.withColumn("own", F.pmod(F.hash("c"), "blocks"))
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    rows = rows.withColumn("group", F.xxhash64("shingle", F.least("own", "other"), F.greatest("own", "other")))
    rows = rows.select("group", "c", "p", "root").join(_grows(bits.select("c", "n", "bits")), "c").select("group", "c", "n", "p", "root", "bits")
    schema = pa.schema([("q", pa.int64()), ("c", pa.int64())])

    def compare(batches):
        held = None
        for batch in batches:
            part = pa.Table.from_batches([batch])
            held = part if held is None else pa.concat_tables([held, part])
            group = held.column("group").to_numpy()
            last = int(np.flatnonzero(group == group[-1])[0]) if len(group) else 0
            if last:  # the last group may go on in the next batch
                yield from _compared(held.slice(0, last), schema)
                held = held.slice(last)
        if held is not None and held.num_rows:
            yield from _compared(held, schema)

    return (
        rows.repartition("group").sortWithinPartitions("group", "n", "c").mapInArrow(compare, "q long, c long").distinct()
    )


def _compared(rows: pa.Table, schema):
    """Pairs of classes of rows that are sorted by group and size; the smaller set comes first."""
    rows = rows.combine_chunks()
    group, c, n, p, root = (rows.column(k).to_numpy() for k in ("group", "c", "n", "p", "root"))
    bits = _bit_rows(rows.column("bits"))
    change = np.flatnonzero(group[1:] != group[:-1]) + 1
    stops = np.append(change, len(group))
    end = np.repeat(stops, np.diff(np.concatenate([[0], stops])))
    at, step = np.arange(len(c)), 1
    while True:  # every row with the one `step` rows on, as long as that is in the group and of like size
        at = at[at + step < end[at]]
        at = at[n[at].astype(np.int64) * 100 >= n[at + step].astype(np.int64) * PERCENT]
        if not len(at):
            return
        a = at[root[at] != root[at + step]]
        a = a[p[a] + p[a + step] <= _most_different(n[a].astype(np.int64), n[a + step]) + 1e-6]
        a = a[_may_link(n[a], n[a + step], bits[a], bits[a + step])]
        if len(a):
            yield pa.RecordBatch.from_arrays([pa.array(c[a]), pa.array(c[a + step])], schema=schema)
        step += 1


def divide_skip(query, candidates):
    """Overlaps of those candidates which reach the overlap needed to link; (positions, overlaps).

    `query` and the candidates are sorted arrays of shingles. The query's shingles are inverted
    lists over the candidates.
    """
    sizes = np.array([len(x) for x in candidates], np.int64)
    needed = overlap_needed(len(query), sizes)
    least = max(1, int(needed.min()))
    of = np.repeat(np.arange(len(candidates)), sizes)
    everything = np.concatenate(candidates)
    place = np.minimum(np.searchsorted(query, everything), len(query) - 1)
    member = query[place] == everything
    shingle, of = place[member], of[member]
    length = np.bincount(shingle, minlength=len(query))
    longest = int(length.max(initial=0))
    # the number of lists to set aside; more of them pay the fewer long lists are probed
    n_long = min(least - 1, int(least / (0.0085 * math.log2(max(2, longest)) + 1)), len(query))
    long = np.zeros(len(query), bool)
    long[np.argsort(length, kind="stable")[len(query) - n_long :]] = True
    in_long = long[shingle]
    count = np.bincount(of[~in_long], minlength=len(candidates))  # the merge of the short lists
    found = np.flatnonzero((count >= least - n_long) & (len(query) * 100 >= sizes * PERCENT))
    # lists are in order of candidate; a list's entries lie together after this
    order = np.argsort(shingle[in_long], kind="stable")
    entry = shingle[in_long][order] * len(candidates) + of[in_long][order]
    wanted = np.flatnonzero(long)[:, None] * len(candidates) + found[None, :]
    at = np.minimum(np.searchsorted(entry, wanted), max(0, len(entry) - 1))
    hits = (entry[at] == wanted).sum(0) if len(entry) else np.zeros(len(found), np.int64)
    total = count[found] + hits
    reached = total >= needed[found]
    return found[reached], total[reached]


def _picked_sets(rows: DataFrame, wanted: DataFrame) -> DataFrame:
    """(c, s): the shingle sets of the documents in `wanted` (c, mark), read again from the texts.

    A filter of a fixed number of bits keeps most other texts from leaving their task; when the
    corpus outgrows it, more sets are sent, with the same result.
    """
    slot = F.pmod(F.col("c").bitwiseXOR(F.col("mark")), F.lit(PICK_BITS))
    shared = _picked(rows.sparkSession, wanted.select(slot.alias("slot")))

    def read(batch):
        pick = shared.value
        mark = batch.column("mark").to_numpy()
        for a, b, data, borders in w.pieces(batch.column("text")):
            keys, first = shingle_sets(data, borders)
            c = set_class(keys, first)
            chosen = np.flatnonzero(_has(pick, (c ^ mark[a:b]) & (PICK_BITS - 1)) & (np.diff(first) > 0))
            if len(chosen):
                values = np.concatenate([keys[first[t] : first[t + 1]] for t in chosen]).view(np.int64)
                cut = pa.array(np.concatenate([[0], np.cumsum(np.diff(first)[chosen])]), pa.int32())
                yield {"c": c[chosen], "s": pa.ListArray.from_arrays(cut, pa.array(values))}

    return map_batches(_marked(rows).select("mark", "text"), read, "c long, s array<long>")


def _links(rows: DataFrame, pairs: DataFrame, classes: DataFrame) -> DataFrame:
    """(a, b): the pairs (q, c) that link, found by searching each query's candidates.

    A query with many candidates is searched in parts of about CANDIDATES; its set goes to each.
    """
    parts = pairs.groupBy("q").agg(F.ceil(F.count("*") / CANDIDATES).cast("int").alias("parts"))
    dealt = pairs.join(_grows(parts), "q").select("q", F.pmod(F.hash("c"), "parts").alias("part"), "c")
    dealt = dealt.select("q", "part", "c", F.lit(1).alias("role")).union(
        dealt.select("q", "part", F.col("q").alias("c"), F.lit(0).alias("role")).distinct()
    )
    wanted = dealt.select("c").distinct().join(classes.select("c", "mark"), "c")
    sets = _picked_sets(rows, wanted)
    grouped = _grows(dealt).join(_grows(sets), "c").repartition("q", "part").sortWithinPartitions("q", "part", "role")
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def search(batches):
        key, query, c, s = None, None, [], []

        def found():
            if query is not None and s:
                at, _ = divide_skip(query, s)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(at), key[0], np.int64)), pa.array(np.array(c, np.int64)[at])], schema=schema
                )

        for batch in batches:
            q, part, role, node = (batch.column(x).to_pylist() for x in ("q", "part", "role", "c"))
            lists = batch.column("s")
            for i in range(batch.num_rows):
                if (q[i], part[i]) != key:
                    yield from found()
                    key, query, c, s = (q[i], part[i]), None, [], []
                own = np.asarray(lists[i].values).view(np.uint64)
                if role[i] == 0:
                    query = own
                else:
                    c.append(node[i])
                    s.append(own)
        yield from found()

    return grouped.select("q", "part", "role", "c", "s").mapInArrow(search, "a long, b long")


def _joined(roots: DataFrame | None, links: DataFrame) -> DataFrame:
    """Components of links and of what is joined already, whose trees stand for their links."""
    links = staged(links, "links")
    return components(links if roots is None else links.union(roots.select("node", "root")))


def jaccard_join(docs: DataFrame, id_col="doc_id", text_col="text") -> DataFrame:
    """One row per row of `docs`: id, n_shingles (size of the set), component_id.

    component_id is the smallest id that links lead to, the row's own included. A null, empty or
    blank text has no shingles and links to nothing, not even to another such text: its
    component_id is its id. A null id is no component's name unless all its members lack one.
    Rows that repeat give the same row each. An empty table gives no rows; other columns are not read.
    """
    return _with_components(id_and_text(docs, id_col, text_col)).select(
        F.col("id").alias(id_col), F.col("n").cast("long").alias("n_shingles"), "component_id"
    )


def _with_components(rows: DataFrame) -> DataFrame:
    """(id, text_mark, n, root, component_id) of every row; rows without shingles have no root."""
    classed = staged(_classed(rows), "classed")
    some = classed.filter("n > 0")
    classes = staged(some.groupBy("c").agg(F.min(F.struct(F.isnull("id"), "id", "mark")).alias("x")).select("c", "x.id", "x.mark"), "classes")
    sets = staged(_described(rows, _frequent(rows)).filter("n > 0").dropDuplicates(["c"]), "sets")
    lists = staged(_lists(sets), "lists")
    roots = None
    for _ in range(STAR_ROUNDS):
        pairs = staged(_open_pairs(_star_pairs(lists, roots), sets), "star-pairs")
        roots = _joined(roots, _links(rows, pairs, classes))
    pairs = staged(_open_pairs(_rest_pairs(lists, sets, roots), sets), "rest-pairs")
    roots = _joined(roots, _links(rows, pairs, classes))
    named = classes.join(roots.withColumnRenamed("node", "c"), "c", "left").select(
        "c", "id", F.coalesce("root", "c").alias("root")
    )
    least = named.groupBy("root").agg(F.min("id").alias("component_id"))
    named = named.join(least, "root").select("c", "root", "component_id")
    alone = classed.filter("n = 0").select("id", "text_mark", "n", F.lit(None).cast("long"), "id")
    return (
        some.select("id", "text_mark", "n", "c").join(named, "c")
        .select("id", "text_mark", "n", "root", "component_id").union(alone)
    )


def keep_one(docs: DataFrame, id_col="doc_id", text_col="text") -> DataFrame:
    """The rows of `docs`, with all columns, of one document of each component: that with its smallest id.

    Documents without shingles all stay. Rows that repeat an id are one document and leave one row,
    if they are in one component; of a component without any id all rows stay. Every row is judged by
    its own text: an id with texts in several components has a row in each of which it is the smallest.
    """
    found = staged(_with_components(id_and_text(docs, id_col, text_col)), "components")
    # of a component's smallest id, one text; what has no shingles or no id in its component is not judged
    judged = found.filter("n > 0 and component_id is not null")
    texts = judged.filter("id = component_id")
    chosen = texts.groupBy("root").agg(F.min("text_mark").alias("chosen"))
    stays = F.col("id").eqNullSafe(F.col("component_id")) & (F.col("text_mark") == F.col("chosen"))
    gone = (
        judged.join(_grows(chosen), "root").filter(~stays)
        .select(F.col("id").alias("gone"), F.col("text_mark").alias("gone_mark")).distinct()
    )
    names = {c: f"c{i}" for i, c in enumerate(docs.columns)}
    packed = docs.select(*[F.col(f"`{c}`").alias(x) for c, x in names.items()])
    key, mark = F.col(names[id_col]), F.xxhash64(names[text_col])
    kept = packed.join(
        gone.hint("shuffle_hash"), key.eqNullSafe(F.col("gone")) & (mark == F.col("gone_mark")), "left_anti"
    )
    n, n_texts = texts.agg(F.count("*"), F.count_distinct("id", "text_mark")).first()
    if n_texts < n:  # some id repeats with the same text: one row, if the text has words
        blank = F.coalesce(F.length(F.regexp_replace(F.col(names[text_col]), "[\\x20\\x09-\\x0D]", "")), F.lit(0)) == 0
        whole, free = F.to_json(F.struct(*names.values())), blank | key.isNull()
        # rows that stay anyway are not brought together
        own = Window.partitionBy(key, mark, F.when(free, F.xxhash64(whole))).orderBy(whole)
        numbered = kept.withColumn("_n", F.row_number().over(own))
        kept = numbered.filter((F.col("_n") == 1) | free).drop("_n")
    return kept.select(*[F.col(x).alias(c) for c, x in names.items()])
