"""Operators over the whole corpus, against brute force."""

import base64
import collections
import hashlib
import itertools
import json
import math
import random
import re
import uuid
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from caselode.llm import components, jaccard_join, line_dedup, mixing, quality_classifier, range_coder, token_output, warc
from caselode.llm.queries import tokenizer_file

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def documents(spark, folder):
    return spark.read.parquet(f"{folder}/documents.parquet")


# links between documents


def shingles(text):
    ws = (text or "").encode().lower().split()
    return {tuple(ws[i : i + 4]) for i in range(len(ws) - 3)} if len(ws) >= 4 else ({tuple(ws)} if ws else set())


def plain_components(rows):
    """(id, number of shingles, smallest id of the component) of every row."""
    sets = [shingles(t) for _, t in rows]
    root, lists = list(range(len(rows))), collections.defaultdict(list)

    def find(a):
        while root[a] != a:
            a = root[a]
        return a

    for i, s in enumerate(sets):
        common = collections.Counter()
        for k in s:
            common.update(lists[k])
            lists[k].append(i)
        for j, n in common.items():
            if 100 * n >= 85 * (len(s) + len(sets[j]) - n):
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    least = {}
    for i, (key, _) in enumerate(rows):
        if key is not None:
            least[find(i)] = min(key, least.get(find(i), key))
    return [(key, len(s), least.get(find(i)) if s else key) for i, ((key, _), s) in enumerate(zip(rows, sets))]


def near_copies():
    """Families of near copies at all similarities around the limit, with a passage that all share."""
    rng = random.Random(11)
    made = []
    passage = [f"p{i}" for i in range(60)]
    for family in range(6):
        base = [f"w{rng.randrange(5000)}" for _ in range(rng.choice([12, 60, 200]))]
        for _ in range(25):
            own = list(base)
            for _ in range(rng.randrange(0, max(2, len(base) // 25))):
                own[rng.randrange(len(own))] = f"n{rng.randrange(10**6)}"
            made.append(" ".join(own + (passage if rng.random() < 0.3 else [])))
    return [(i, t) for i, t in enumerate(made)]


@pytest.mark.parametrize("source", ["tables", "edges", "families", "small parts"])
def test_components_equal_brute_force(spark, folder, edge_docs, monkeypatch, source):
    if source == "small parts":  # many blocks, parts and batches; a filter that lets nearly all through
        monkeypatch.setattr(jaccard_join, "BLOCK", 4)
        monkeypatch.setattr(jaccard_join, "CANDIDATES", 2)
        monkeypatch.setattr(jaccard_join, "PICK_BITS", 64)
        monkeypatch.setattr(jaccard_join, "FREQUENT", 5)
    docs = {"tables": lambda: documents(spark, folder), "edges": lambda: edge_docs}.get(
        source, lambda: spark.createDataFrame(near_copies(), "doc_id long, text string").repartition(5)
    )()
    want = plain_components([(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()])
    got = [tuple(r) for r in jaccard_join.jaccard_join(docs).collect()]
    assert collections.Counter(got) == collections.Counter(want)
    if source == "families":
        assert 6 < len({c for _, _, c in got}) < len(got) - 20


def patterned_texts():
    """Two words, and lines of them, that agree under every polynomial hash modulo 2**64."""
    one = "".join("ab"[i.bit_count() & 1] for i in range(1024))
    other = one.translate(str.maketrans("ab", "ba"))
    return [one, other, f"{one}\n{one} x\n{one} y", f"{other}\n{other} x\n{other} y"]


def test_patterned_texts_are_told_apart(spark):
    texts = patterned_texts()
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").coalesce(1)
    assert {r.component_id for r in jaccard_join.jaccard_join(docs).collect()} == {0, 1, 2, 3}
    assert {r.n_removed for r in line_dedup.line_dedup(docs).collect()} == {0}
    encoder = token_output.PieceEncoder(tokenizer_file())
    ids, cut = encoder.encode(*token_output.w.text_bytes(pa.array(texts)))
    for i, text in enumerate(texts):
        assert ids[cut[i] : cut[i + 1]].tolist() == encoder.tokenizer.encode(text, add_special_tokens=False).ids


def test_jaccard_join_writes_lists_and_bits_once_per_class(spark, monkeypatch):
    real, written = jaccard_join.staged, {}

    def staged(df, name):
        written[name] = real(df, name)
        return written[name]

    monkeypatch.setattr(jaccard_join, "staged", staged)
    text = " ".join(f"w{i}" for i in range(40))
    docs = spark.createDataFrame([(i, f"{text} v{i % 2}") for i in range(30)] + [(30, None)], "doc_id long, text string")
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard_join.jaccard_join(docs).collect()}
    assert got == {i: (38, 0) for i in range(30)} | {30: (0, 30)}
    heavy = {name: df.count() for name, df in written.items() if {"shingles", "bits", "wide"} & set(df.columns)}
    assert heavy == {"sets": 2}  # two texts, thirty rows


def test_one_of_each_component_stays(edge_docs, no_docs):
    kept = jaccard_join.keep_one(edge_docs)
    assert kept.columns == edge_docs.columns
    ids = sorted((r.doc_id for r in kept.collect()), key=lambda x: (x is None, x))
    # 6 equals 5 but for case, 8 (twice) equals 7; texts without words all stay
    assert ids == [1, 2, 3, 4, 5, 7, 9, 10, 11, 12, 13, 14, 15, 16, 17, None]
    assert jaccard_join.keep_one(no_docs).count() == 0


def test_rows_without_id_and_texts_of_one_id_are_judged_one_by_one(spark):
    prose = {k: " ".join(f"{k}{i}" for i in range(40)) for k in "abcdef"}
    rows = [
        (1, prose["a"]), (None, prose["a"] + " x"), (None, prose["b"]), (None, None), (None, " "), (None, prose["c"]), (None, prose["c"]),
        (7, prose["a"]), (7, prose["d"]), (8, prose["e"]), (8, prose["f"]), (8, prose["f"]), (8, prose["f"] + " x"), (9, prose["f"]),
    ]
    docs = spark.createDataFrame([(*r, k) for k, r in enumerate(rows)], "doc_id long, text string, k int").repartition(3)
    kept = sorted(r.k for r in jaccard_join.keep_one(docs).collect())
    # only the null-id copy of 1 goes; 7 stays with its own text; 8 has one row in each of two components
    assert [k for k in kept if k not in (10, 11, 12)] == [0, 2, 3, 4, 5, 6, 8, 9]
    assert len(kept) == 9


def test_divide_skip_finds_exactly_the_links():
    rng = np.random.default_rng(4)
    for _ in range(300):
        query = np.unique(rng.integers(0, 200, rng.integers(1, 60)).astype(np.uint64))
        found = []
        for _ in range(rng.integers(1, 12)):
            x = query[rng.random(len(query)) < rng.choice([0.3, 0.9, 0.97, 1.0])]
            x = np.unique(np.concatenate([x, rng.integers(200, 400, rng.integers(0, 6)).astype(np.uint64)]))
            found.append(x if len(x) else np.array([999], np.uint64))
        at, common = jaccard_join.divide_skip(query, found)
        want = {}
        for i, x in enumerate(found):
            n = len(np.intersect1d(query, x))
            if 100 * n >= 85 * (len(query) + len(x) - n):
                want[i] = n
        assert dict(zip(at.tolist(), common.tolist())) == want


@pytest.mark.parametrize("n", [0, 1, 40])
def test_components_of_random_graphs(spark, n):
    rng = random.Random(n)
    links = [(rng.randrange(60), rng.randrange(60)) for _ in range(n)] + [(None, 1), (3, 3)] + [(100 + i, 101 + i) for i in range(20)]
    root = {}

    def find(a):
        while root.setdefault(a, a) != a:
            a = root[a]
        return a

    for a, b in links:
        if a is not None and a != b:
            x, y = find(a), find(b)
            root[max(x, y)] = min(x, y)
    got = {r.node: r.root for r in components.components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {a: find(a) for a in root}


# mixing


def plain_mix(rows):
    """rows: (id, text, source); the fluid queue served up to the targets, in whole words."""
    sized = [(i, len(WORD.findall(t or "")), s) for i, t, s in rows]
    total = collections.Counter()
    for _, n, s in sized:
        total[s] += n
    sources = sorted(total, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: (5, 2, 1)[k % 3] for k, s in enumerate(sources)}
    budget, capped = 1.5 * sum(total.values()), set()
    while True:
        rest = sum(w for s, w in weight.items() if s not in capped)
        rate = (budget - sum(2 * total[s] for s in capped)) / rest if rest else 0
        more = {s for s in sources if s not in capped and weight[s] * rate > 2 * total[s]}
        if not more:
            break
        capped |= more
    return sized, total, {s: 2.0 * total[s] if s in capped else weight[s] * rate for s in sources}


@pytest.mark.parametrize("source", ["tables", "edges"])
def test_mix_meets_its_targets(spark, folder, edge_docs, monkeypatch, source):
    monkeypatch.setattr(mixing, "RUN", 2)
    docs = documents(spark, folder) if source == "tables" else edge_docs
    rows = [(r.doc_id, r.text, r.source) for r in docs.collect()]
    sized, total, target = plain_mix(rows)
    got = mixing.mix_sizes(docs).collect()
    assert len(got) == len(rows)
    by_id = collections.defaultdict(set)
    for i, _, s in rows:
        by_id[i].add(s)
    taken = collections.Counter()
    for r in got:
        s = next(s for s in by_id[r.doc_id] if total[s] == r.source_size)
        taken[s] += r.taken
        assert abs(r.target - target[s]) < 1e-6 * max(1, target[s])
        assert 0 <= r.taken <= 2 * r.size
    assert collections.Counter((r.doc_id, r["size"]) for r in got) == collections.Counter((i, n) for i, n, _ in sized)
    for s, t in target.items():
        assert abs(taken[s] - t) <= 1
    again = mixing.mix_sizes(docs.repartition(7)).collect()
    assert collections.Counter(map(tuple, again)) == collections.Counter(map(tuple, got))
    mixed = mixing.mix(docs)
    assert mixed.columns == docs.columns
    words = collections.Counter()
    for r in mixed.collect():
        words[r.doc_id] += len(WORD.findall(r.text or ""))
    want = collections.Counter()
    for r in got:
        want[r.doc_id] += r.taken
    assert +words == +want


def test_mix_is_cut_in_the_order_of_finish_times(spark):
    rows = [(i, "w " * (i % 9), "abc"[i % 3] if i % 31 else None) for i in range(400)] + [(900, "w " * 300, "a"), (901, "w " * 300, "b")]
    sizes = mixing.with_sizes(spark.createDataFrame(rows, "id long, text string, source string"), {"id": "id", "source": "source"}, "text")
    goal = mixing.targets(sizes)
    order = mixing.in_order(mixing.turns(mixing.queue(sizes, goal)))
    turns = sorted(order.collect(), key=lambda r: (r.finish, r.source or "", r.start))
    assert len(turns) == 2 * sum(len(t) > 0 for _, t, _ in rows)
    assert [r.served for r in turns] == list(itertools.accumulate(r["size"] for r in turns))
    got = {(r.source, r.start): r.taken for r in mixing.cut(order, goal).collect()}
    budget = sum(math.floor(r.target) for r in goal.collect())
    # whole documents up to the cut, one document in service per source behind it, and nothing of the others
    n_whole = next(i for i, r in enumerate(turns) if got[r.source, r.start] < r["size"])
    assert all(r.finish <= 1 for r in turns[:n_whole]) and all(r.finish > 1 for r in turns[n_whole:])
    behind = collections.defaultdict(list)
    for r in turns[n_whole:]:
        behind[r.source].append(got[r.source, r.start])
    assert not any(n for queue in behind.values() for n in queue[1:])
    assert turns[n_whole - 1].served + sum(queue[0] for queue in behind.values()) == sum(got.values()) == budget


def test_mix_of_rows_that_agree(spark, monkeypatch):
    monkeypatch.setattr(mixing, "RUN", 16)
    rows = [(None, "same words here", "a", i) for i in range(120)] + [(7, f"other {i}", "a", i) for i in range(90)]
    rows += [(None, f"text {i} of many", "a", i) for i in range(60)] + [(i, "x y", "b", i) for i in range(400)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, extra long").repartition(5)
    _, total, target = plain_mix([r[:3] for r in rows])
    got = mixing.mix_sizes(docs).collect()
    assert collections.Counter((r.doc_id, r["size"]) for r in got) == collections.Counter(
        (i, len(t.split())) for i, t, _, _ in rows
    )
    for s, t in target.items():
        assert abs(sum(r.taken for r in got if r.source_size == total[s]) - t) <= 1
    again = mixing.mix_sizes(docs.repartition(3)).collect()
    assert collections.Counter(map(tuple, again)) == collections.Counter(map(tuple, got))
    mixed = mixing.mix(docs).collect()
    for s, t in target.items():
        assert abs(sum(len(r.text.split()) for r in mixed if r.source == s) - t) <= 1
    # no row is taken more than twice, and whole rows keep their other columns
    assert max(collections.Counter((r.doc_id, r.source, r.extra, r.text) for r in mixed).values()) <= 2
    assert {r.extra for r in mixed if r.source == "b"} <= set(range(400))


def test_a_text_in_many_rows_is_split_over_tasks(spark):
    rows = [(None, None if i % 2 else "a b", "s") for i in range(4000)] + [(i, f"w{i}", "s") for i in range(4000)]
    docs = spark.createDataFrame(rows, "id long, text string, source string")
    sizes = mixing.with_sizes(docs, {"id": "id", "source": "source"}).cache()
    queue = mixing.queue(sizes, mixing.targets(sizes))
    assert queue.count() == 4002 and queue.agg(F.sum("copies")).first()[0] == 8000
    lots = sizes.withColumn("lot", F.spark_partition_id())
    numbers = mixing.numbered(lots, ["source", "id", "mark", "size"])
    got = [r.number for r in numbers.filter("id is null and size = 2").collect()]
    assert sorted(got) == list(range(2000))
    sizes.unpersist()


def test_mix_of_nothing(spark, no_docs):
    assert mixing.mix_sizes(no_docs).count() == 0 and mixing.mix(no_docs).count() == 0
    blank = spark.createDataFrame([(1, None, "a"), (2, " ", None)], "doc_id long, text string, source string")
    assert [tuple(r) for r in mixing.mix_sizes(blank).orderBy("doc_id").collect()] == [(1, 0, 0, 0.0, 0), (2, 0, 0, 0.0, 0)]


def test_ranks_are_in_order_of_code_points(spark):
    names = ["b", "a", "é", "Z", "\U0001f600", "￿", None, "aa"]
    got = {r.s: r["rank"] for r in mixing.ranked(spark.createDataFrame([(n,) for n in names], "s string").repartition(4), "s").collect()}
    want = sorted((n for n in names if n is not None), key=lambda n: n.encode()) + [None]
    assert got == {n: i for i, n in enumerate(want)}


# lines


def plain_dedup(rows):
    """rows: (id, text) with distinct ids; (id, n_lines, n_removed, text)."""
    places, lines_of = collections.defaultdict(list), {}
    for i, t in rows:
        lines = [(k, x) for k, x in enumerate((t or "").split("\n")) if WORD.search(x)]
        lines_of[i] = lines
        texts = [x for _, x in lines]
        size = min(3, len(texts))
        for p in range(len(texts) - size + 1 if size else 0):
            places[tuple(texts[p : p + size])].append((i, p, size))
    gone = collections.defaultdict(set)
    for found in places.values():
        for i, p, size in sorted(found, key=lambda x: (x[0] is not None, x))[1:]:
            gone[i].update(lines_of[i][q][0] for q in range(p, p + size))
    for i, t in rows:
        kept = None if t is None else "\n".join(x for k, x in enumerate(t.split("\n")) if k not in gone[i])
        yield i, len(lines_of[i]), len(gone[i]), kept


@pytest.mark.parametrize("source", ["tables", "edges", "made up"])
def test_lines_equal_brute_force(spark, folder, edge_docs, source):
    if source == "made up":
        rng = random.Random(9)
        rows = [(i, "\n".join(rng.choice(["a", "b", "c", " ", "d e"]) for _ in range(rng.randrange(0, 12)))) for i in range(200)]
        docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    else:
        docs = documents(spark, folder) if source == "tables" else edge_docs
    rows = list({(r.doc_id, r.text) for r in docs.collect()})
    got = {tuple(r) for r in line_dedup.line_dedup(docs).collect()}
    assert got == set(plain_dedup(rows))
    assert line_dedup.line_dedup(docs).count() == docs.count()


def test_lines_of_rows_without_id_and_of_one_id_are_their_own(spark):
    rng = random.Random(12)
    texts = ["\n".join(rng.choice(["a", "b", "c", " ", "d e"]) for _ in range(rng.randrange(0, 12))) for _ in range(60)]
    texts += ["\n".join(f"{k}{i}" for i in range(5)) for k in ("once ", "also once ")] + ["x\n \ny\nz"] * 3 + [None, None]
    rows = [(None if k % 3 else k // 6, t) for k, t in enumerate(texts)] + [(70, "x\n \ny\nz\nown"), (70, "p\nq\nr"), (70, "p\nq\nr")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    marked = [tuple(r) for r in docs.select("doc_id", F.xxhash64("text").alias("mark"), "text").collect()]
    order = sorted(marked, key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
    # rows that repeat an id with the same text are one document; each row without an id is one
    names, own = {}, []
    for k, r in enumerate(order):
        names[k] = names[k - 1] if k and r[0] is not None and r == order[k - 1] else k
        own.append(names[k])
    plain = {k: found for k, *found in plain_dedup([(k, order[k][2]) for k in sorted(set(own))])}
    want = collections.Counter((order[k][0], *plain[own[k]]) for k in range(len(order)))
    assert collections.Counter(map(tuple, line_dedup.line_dedup(docs).collect())) == want
    kept = [r.text for r in line_dedup.line_dedup(docs).filter("n_removed = 0").collect()]
    assert texts[60] in kept and texts[61] in kept


def test_no_lines(no_docs):
    assert line_dedup.line_dedup(no_docs).count() == 0


# archives


def plain_captures(rows, least=0):
    groups = collections.defaultdict(list)
    for i, html in rows:
        groups[html or ""].append(i)
    for i, html in rows:
        body = (html or "").encode()
        ids = [x for x in groups[html or ""] if x is not None]
        first = min(ids) if ids and len(body) >= least else i
        revisit = first != i
        yield i, len(body), base64.b32encode(hashlib.sha1(body).digest()).decode(), "revisit" if revisit else "response", first if revisit else None


PAGES = [
    (1, "http://a/?x=1", "<p>é\r\n\r\nWARC/1.1\r\n</p>"), (2, None, None), (3, "http://b/\r\nX: y", ""), (4, "u", "same"), (5, "u", "same"),
    (5, "u", "same"), (None, "u", "same"), (None, None, "alone"), (6, "", "\n"), (7, "v", "x" * 700_000), (4, "u", "same"),
]


def archived(spark, pages, tmp_path, **more):
    path = f"file://{tmp_path}/{uuid.uuid4().hex}"
    warc.write_archives(pages, path, **more)
    rows = warc.with_referred_pages(warc.captures(warc.read_records(spark, path)))
    number = lambda x: None if x is None else int(x)
    return [
        ((number(r.page), r.response.payload_bytes, r.response.payload_digest, r.response.kind, number(r.refers_to)), r)
        for r in rows.collect()
    ]


@pytest.mark.parametrize("least", [0, 5])
def test_archives_hold_the_pages(spark, tmp_path, least):
    pages = spark.createDataFrame([(*p, 1, "x") for p in PAGES], "page_id long, url string, html string, digest int, first string")
    got = archived(spark, pages.repartition(3), tmp_path, min_bytes=least)
    assert collections.Counter(k for k, _ in got) == collections.Counter(plain_captures([(i, h) for i, _, h in PAGES], least))
    for key, r in got:
        assert r.request.record_id and r.metadata.page == r.page
        if key[3] == "response":
            assert r.response.payload.encode() is not None and len(r.response.payload.encode()) == key[1]
        else:
            assert r.response.payload is None
    urls = {r.page: r.target_uri for _, r in got}
    assert urls["1"] == "http://a/?x=1" and urls["3"] == "http://b/%0D%0AX: y" and urls["2"] is None


def test_archives_of_the_table(spark, folder, tmp_path, monkeypatch):
    monkeypatch.setattr(warc, "RECORDS_PER_FILE", 7)
    pages = spark.read.parquet(f"{folder}/pages.parquet")
    got = archived(spark, pages.unionAll(pages.withColumn("page_id", F.col("page_id") + 1000)), tmp_path)
    rows = [(r.page_id, r.html) for r in pages.collect()]
    assert collections.Counter(k for k, _ in got) == collections.Counter(plain_captures(rows + [(i + 1000, h) for i, h in rows]))


def test_no_pages_and_damaged_archives(spark, tmp_path):
    pages = spark.createDataFrame(PAGES, "page_id long, url string, html string")
    assert archived(spark, pages.limit(0), tmp_path) == []
    with pytest.raises(ValueError):
        list(warc.parse(b"WARC/1.1\r\nContent-Length: 10\r\n\r\nshort"))
    with pytest.raises(ValueError):
        list(warc.parse(b"HTTP/1.1 200\r\nContent-Length: 1\r\n\r\nx\r\n\r\n"))


def test_pages_without_id_are_no_group(spark, tmp_path):
    pages = spark.createDataFrame([(None, "u", "same")] * 40 + [("", "u", "same"), ("a+ b", "u", "x")], "page_id string, url string, html string")
    path = f"file://{tmp_path}/{uuid.uuid4().hex}"
    warc.write_archives(pages.repartition(4), path)
    records = warc.read_records(spark, path)
    assert records.groupBy("key").count().agg(F.max("count")).first()[0] == 3
    rows = warc.with_referred_pages(warc.captures(records)).collect()
    assert collections.Counter((r.page, r.response.kind, r.refers_to) for r in rows) == {
        (None, "revisit", ""): 40, ("", "response", None): 1, ("a+ b", "response", None): 1,
    }


def test_members_of_gzip_and_plain_archives_read_alike():
    record = lambda i: f"WARC/1.1\r\nWARC-Type: metadata\r\nContent-Length: {len(i)}\r\n\r\n{i}\r\n\r\n".encode()
    texts = ["a", "", "x" * 600_000, "\r\n\r\n"]
    gzip = lambda b: (c := zlib.compressobj(wbits=31)).compress(b) + c.flush()
    for content in (b"".join(map(record, texts)), b"".join(gzip(record(t)) for t in texts), gzip(b"".join(map(record, texts)))):
        assert [b.decode() for _, b in warc.parse(content)] == texts


# tokens


def test_blocks_round_trip():
    rng = np.random.default_rng(1)
    cases = [
        [np.array([], int)], [np.array([65535])], [np.zeros(5000, int)], [rng.integers(0, 65536, 700)], [],
        [rng.zipf(1.2, size=n) % 50257 for n in (0, 1, 255, 256, 257, 1024, 1025, 4096, 5000, 3)],
        [np.repeat([7, 65535, 0], 400)], [np.arange(3000) % 17 for _ in range(9)],
    ]
    for blocks in cases:
        coded = range_coder.encode(blocks)
        for a, b in zip(blocks, range_coder.decode(coded, [len(b) for b in blocks]), strict=True):
            assert np.array_equal(a, b)
    with pytest.raises(ValueError):
        range_coder.encode([np.array([65536])])


def test_predictions_pay():
    rng = np.random.default_rng(2)
    skewed = np.minimum(rng.geometric(0.05, 4096), 60000)
    assert len(range_coder.encode([skewed])[0]) < 0.6 * 2 * 4096  # order 0
    phrases = np.concatenate([rng.permutation(50)] * 80)
    assert len(range_coder.encode([phrases])[0]) < 0.15 * 2 * len(phrases)  # orders 1 and 2


def test_blocks_do_not_depend_on_each_other(monkeypatch):
    rng = np.random.default_rng(3)
    blocks = [rng.zipf(1.3, size=n) % 50000 for n in (900, 10, 2000, 2000)]
    together = range_coder.encode(blocks)
    assert together == [range_coder.encode([b])[0] for b in blocks]
    monkeypatch.setattr(range_coder, "LANES", 2)
    assert range_coder.encode(blocks) == together


def test_pieces_have_the_ids_of_whole_texts():
    encoder = token_output.PieceEncoder(tokenizer_file())
    rng = random.Random(1)
    parts = [" ", " ", "\n", "\t", "\r", "\x0b", "a", "b", "'s", "é", "1", ".", "\xa0", "x", "<|", "<|endoftext|>", "　", " ", "“", "\x85"]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randint(0, 14))) for _ in range(4000)]
    ids, first = encoder.encode(*token_output.w.text_bytes(pa.array(texts)))
    for i, e in enumerate(encoder.tokenizer.encode_batch(texts, add_special_tokens=False)):
        assert ids[first[i] : first[i + 1]].tolist() == e.ids, texts[i]


def plain_tokens(rows):
    from tokenizers import Tokenizer

    tokenizer, start = Tokenizer.from_file(tokenizer_file()), 0
    for i, text in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, (r[1] or "").encode())):
        ids = tokenizer.encode(text or "", add_special_tokens=False).ids + [0]
        yield i, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()), ids
        start += len(ids)


@pytest.mark.parametrize("source", ["tables", "edges"])
def test_tokens_read_back(spark, folder, edge_docs, tmp_path, monkeypatch, source):
    docs = (documents(spark, folder) if source == "tables" else edge_docs.filter("doc_id is null or doc_id not in (13, 14, 15, 16)"))
    if source == "tables":  # many segments
        monkeypatch.setattr(token_output, "SEGMENT_IDS", 3000)
        monkeypatch.setattr(token_output, "TEXT_BYTES", 9000)
    want = list(plain_tokens([(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]))
    path = f"file://{tmp_path}/tokens"
    token_output.write_tokens(docs, path, tokenizer_file())
    got = token_output.token_digests(spark, path).collect()
    assert sorted(map(tuple, got), key=lambda r: r[1]) == [w[:4] for w in want]
    ids = token_output.read_tokens(spark, path).orderBy("part", "segment", "offset").collect()
    assert [list(r["ids"]) for r in ids] == [w[4] for w in want]


def test_rows_without_id_are_spread_over_tasks(spark, tmp_path):
    rows = [(None if i % 3 == 0 else 5 if i % 3 == 1 else i, f"{i % 97:02d} text {i}") for i in range(6000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    path, small = f"file://{tmp_path}/tokens", "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(small, "false")  # small tasks are not put together
    try:
        token_output.write_tokens(docs, path, tokenizer_file())
    finally:
        spark.conf.unset(small)
    got = token_output.token_digests(spark, path).collect()
    assert sorted(map(tuple, got), key=lambda r: r[1]) == [w[:4] for w in plain_tokens(rows)]
    of_task = token_output.read_tokens(spark, path, with_ids=False).groupBy("part").count().collect()
    assert max(r["count"] for r in of_task) < 4 * 6000 / len(of_task) and len(of_task) > 2


def test_long_texts_and_empty_tables(spark, no_docs, tmp_path):
    path = f"file://{tmp_path}/none"
    token_output.write_tokens(no_docs, path, tokenizer_file())
    assert token_output.token_digests(spark, path).count() == 0
    long = spark.createDataFrame([(1, "many words " * 60_000)], "doc_id long, text string")
    token_output.write_tokens(long, f"file://{tmp_path}/long", tokenizer_file())
    assert token_output.token_digests(spark, f"file://{tmp_path}/long").first().n_tokens > 120_000


def test_damaged_segments_are_noticed():
    payload = token_output.pack(np.arange(3000) % 91)
    assert np.array_equal(token_output.unpack([payload])[0], np.arange(3000) % 91)
    for at in (0, 60, len(payload) // 2):
        broken = bytearray(payload)
        broken[at] ^= 1
        with pytest.raises(ValueError):
            token_output.unpack([bytes(broken)])
    with pytest.raises(Exception):
        token_output.unpack([payload[:-2]])


# quality classifier


def test_held_out_accuracy(spark, folder):
    folder = f"{folder}/../sf0.01"
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    hidden = F.pmod(F.xxhash64("doc_id", F.lit("test")), F.lit(3)) == 0
    got = quality_classifier.score_quality(documents(spark, folder), labels.filter(~hidden))
    rows = got.join(labels.filter(hidden), "doc_id").collect()
    right = sum(r.kept == (r.quality == 1) for r in rows)
    assert len(rows) > 100 and right >= 0.97 * len(rows)
    good = [r for r in rows if r.quality == 1]
    assert sum(r.kept for r in good) >= 0.98 * len(good)


def test_metadata_teaches_the_text(spark):
    """Labels cover clear junk only; faint junk, of which the text view is unsure, is told by its source."""
    rng = random.Random(5)
    prose = lambda: " ".join("".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 8))) for _ in range(40))
    marked = lambda share: " ".join(x + "$" * (rng.random() < share) for x in prose().split())
    texts = [(i, marked((0, 1, 0.2)[i % 3]), "good.example" if i % 3 == 0 else "junk.example") for i in range(600)]
    docs = spark.createDataFrame([(i, t, s, "en", len(t)) for i, t, s in texts], "doc_id long, text string, source string, lang string, n_chars long").repartition(3)
    labels = spark.createDataFrame([(i, int(i % 3 == 0)) for i in range(300) if i % 3 != 2], "id long, label int")
    rows = quality_classifier.staged(quality_classifier.described(docs, {}, "doc_id", "text", ["source", "lang", "n_chars"]), "test")
    faint = {}
    for rounds in (0, 2):
        got = quality_classifier.cotrain(rows, labels, rounds).scored(rows).collect()
        faint[rounds] = sum(r.text_score for r in got if r._id % 3 == 2) / 200
    assert all((r.score >= 0.5) == (r._id % 3 == 0) for r in got)
    assert faint[2] < faint[0] - 0.05


def worded(n=900):
    """Documents that only three words among forty tell apart, which look like all others; a few are null or empty."""
    rng = random.Random(11)
    made = lambda k: sorted({"".join(rng.choice("abcdefghij") for _ in range(5)) for _ in range(k)})
    usual, telling = made(300), made(12)
    for i in range(n):
        words = [rng.choice(usual) for _ in range(40)]
        if i % 3 == 0:
            for at in rng.sample(range(40), 3):
                words[at] = rng.choice(telling)
        yield i, None if i == 1 else "" if i == 4 else " ".join(words), "s", "en", 200


def test_words_alone_tell_documents_apart(spark):
    rows = list(worded())
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, lang string, n_chars long").repartition(4)
    labels = spark.createDataFrame([(i, int(i % 3 != 0)) for i in range(600)], "doc_id long, quality int")
    got = quality_classifier.score_quality(docs, labels).filter("doc_id >= 600").collect()
    right = sum(r.kept == (r.doc_id % 3 != 0) for r in got)
    assert len(got) == 300 and right >= 0.95 * len(got)


def test_word_counts_equal_plain_counts(spark, monkeypatch):
    monkeypatch.setattr(quality_classifier, "BUCKETS", 1 << 8)
    rows = list(worded(120))
    docs = spark.createDataFrame([r[:2] for r in rows] + [(None, "no id")], "doc_id long, text string").repartition(3)
    labels = spark.createDataFrame([(i, i % 2) for i in range(90)] + [(3, 0), (7, None), (5000, 1)], "id long, label int")
    chance = docs.select("doc_id", quality_classifier._half("doc_id").alias("half"), F.pmod(F.xxhash64("doc_id", F.lit("fold")), F.lit(100)).alias("fold"))
    place = {r.doc_id: (r.half, r.fold) for r in chance.collect()}
    n, has = collections.Counter(), collections.Counter()
    for i, text, *_ in rows[:90]:
        half, fold = place[i]
        if i == 3 or fold < quality_classifier.HELD_OUT:  # 3 has contradicting labels
            continue
        n[half, i % 2] += 1
        (bucket, _), (pair, _) = quality_classifier._buckets(*quality_classifier.w.text_bytes(pa.array([text], pa.string())), 256)
        for b in {*bucket.tolist(), *pair.tolist()}:
            has[half, i % 2, b] += 1
    odds = quality_classifier.learn_words(docs, labels, "doc_id", "text")
    assert odds.shape == (2, 512) and np.count_nonzero(odds)
    for half in (0, 1):
        good, bad = (np.array([has[1 - half, k, b] for b in range(512)]) for k in (1, 0))
        assert np.allclose(odds[half], quality_classifier.log_odds(good, bad, n[1 - half, 1], n[1 - half, 0]))
    assert quality_classifier.learn_words(docs, labels.limit(0), "doc_id", "text") is None


def test_every_unlabelled_document_may_be_handed_over(spark, folder, monkeypatch):
    monkeypatch.setattr(quality_classifier, "POOL_ROWS", 20, raising=False)  # was a bound on them
    held, staged = {}, quality_classifier.staged

    def seen(df, name):
        held[name] = staged(df, name)
        return held[name]

    monkeypatch.setattr(quality_classifier, "staged", seen)
    docs = documents(spark, folder)
    labels = spark.read.parquet(f"{folder}/labels.parquet").limit(60)
    assert quality_classifier.score_quality(docs, labels).count() == docs.count()
    other = docs.join(labels, "doc_id", "left_anti").select("doc_id")
    pool = held["co-training"].filter("label is null").select("_id")
    assert other.count() > 20 and other.exceptAll(pool).isEmpty() and pool.exceptAll(other).isEmpty()


def test_classifier_on_edges(spark, edge_docs, no_docs):
    none = spark.createDataFrame([], "doc_id long, quality int")
    assert quality_classifier.score_quality(no_docs, none).count() == 0
    assert quality_classifier.score_quality(edge_docs, none).filter("kept and score = 1").count() == edge_docs.count()
    labels = spark.createDataFrame([(4, 0), (5, 1), (7, 1), (8, 0), (9, 1), (10, 0), (4, 1), (11, None), (None, 1), (12, 1)], "doc_id long, quality int")
    got = quality_classifier.score_quality(edge_docs, labels)
    assert got.count() == edge_docs.count() and got.filter("score is null or isnan(score)").count() == 0
    kept = quality_classifier.keep_good(edge_docs, labels)
    assert kept.columns == edge_docs.columns and kept.count() == got.filter("kept").count()


# the pipeline


def test_pipeline_stages_follow_from_each_other(spark, folder):
    import corpus_pipeline as pipeline

    docs = documents(spark, folder)
    steps = [docs]
    for _, stage in pipeline.STAGES:
        steps.append(stage(spark, steps[-1], folder).cache())
    rows = [s.collect() for s in steps]
    for a in rows[:5]:
        assert not a or a[0].__fields__ == docs.columns
    assert set(rows[1]) <= set(rows[0])
    by_id = {r.doc_id: r for r in rows[1]}
    least = {i: c for i, _, c in plain_components([(r.doc_id, r.text) for r in rows[1]])}
    assert {r.doc_id for r in rows[2]} == {c for i, c in least.items()} and set(rows[2]) <= set(by_id.values())
    sized, total, target = plain_mix([(r.doc_id, r.text, r.source) for r in rows[3]])
    taken = collections.Counter()
    for r in rows[4]:
        taken[r.source] += len(WORD.findall(r.text))
        assert r.n_chars == len(r.text)
    assert all(abs(taken[s] - t) <= 1 for s, t in target.items())
    want = [w[:4] for w in plain_tokens([(r.doc_id, r.text) for r in rows[4]])]
    assert sorted(map(tuple, rows[5]), key=lambda r: r[1]) == want
    for s in steps[1:]:
        s.unpersist()
    assert json.dumps([n for n, _ in pipeline.STAGES])


def test_copies_are_made_again_in_runs(spark):
    from caselode.llm.common import numbered_copies

    rows = [("a", 1), (None, 10), ("b", 3), ("c", 4)]
    got = numbered_copies(spark.createDataFrame(rows, "x string, copies long"), "copies", run=3)
    assert collections.Counter((r.x, r.number) for r in got.collect()) == collections.Counter(
        (x, i) for x, n in rows for i in range(n)
    )
    assert got.columns == ["x", "number"]


@pytest.mark.parametrize("empty", [False, True])
def test_pipeline_on_edges(spark, edge_docs, folder, tmp_path, empty):
    """Null ids and texts, repeated rows, clashing columns and no rows at all go through every stage."""
    import corpus_pipeline as pipeline

    path = f"file://{tmp_path}"
    docs = edge_docs.filter("doc_id is null or doc_id not in (13, 14, 15, 16)")
    docs.limit(0 if empty else 100).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame([(4, 1), (7, 1), (5, None)], "doc_id long, quality int").write.parquet(f"{path}/labels.parquet")
    spark.createDataFrame([(1, "l2 x l3 x l4 x"), (2, None)], "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    got = pipeline.run(spark, path).collect()
    # 6 is a copy of 5, 8 of 7; 10 and 11 hold the benchmark's passage; 1, 2 and 3 have no words
    left = set() if empty else {4, 5, 7, 9, None, 12, 17}
    assert {r.doc_id for r in got} == left
    assert sum(r.n_tokens for r in got) == max([r.start + r.n_tokens for r in got], default=0)
