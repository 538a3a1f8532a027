"""Exact top-k cosine neighbours of many queries in one job (RET-1 .. RET-5).

A join on terms would emit a row for every pair of documents that share a
frequent word.  Here queries and documents are packed, in whatever task holds
them, into blocks of bounded size.  Every pair of blocks meets once, in a
product that reads the blocks' files and shuffles nothing.  There one matrix
product in single precision, of the terms that many queries have, and the lists
of the others tell every similarity to a known error; it is computed exactly for
those that may be among the best.  A task keeps only the k best per
query of all documents it has seen.  A second top-k merges the tasks.  Blocks
are cut by number of rows, so copies, repeated ids and frequent words do not
skew them.  The result is exact: no candidate is left out.
"""

import math
import sys
from collections.abc import Callable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext, cloudpickle
from pyspark.ml.feature import BucketedRandomProjectionLSH
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame, Window, functions as F, types as T

from caselode import profile as P
from caselode.functions.text import blank_to_empty
from caselode.session import staged

# Executors get these functions by value and need no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Rows of a block of queries, of a file of documents, and of a block of documents.
QUERY_BLOCK, DOC_BLOCK, SLICE = 1_024, 16_384, 2_048
#: Blocks of queries whose best documents a task holds at once.
HELD = 64
DIGITS = 9
#: Share of the lengths' product by which a similarity in single precision may be off, and room for rounding.
ERROR, ROOM = 1e-4, 1e-9
#: How many of a block's terms may be in its matrix product; time of one more, and of one posting read, per pair.
MATRIX_TERMS, MATRIX_COST, POSTING_COST = (64, 128, 256, 512, 1_024), 0.04, 40.0
#: Postings or entries that are laid out at once.
LAID_OUT = 4_194_304


def _ragged(column):
    """Flat numbers and row offsets of a list column."""
    lists = column.combine_chunks()
    if isinstance(lists, pa.ChunkedArray):
        lists = pa.concat_arrays(lists.chunks) if lists.num_chunks else pa.array([], lists.type)
    offsets = lists.offsets.to_numpy()
    return lists.flatten().to_numpy(zero_copy_only=False), offsets - offsets[0]


def _laid_out(sizes, starts):
    """Per run of rows: their numbers, one per entry, and the entries' places; row i has ``sizes[i]`` from ``starts[i]`` on."""
    upto = np.cumsum(sizes)
    cuts = np.searchsorted(upto, np.arange(LAID_OUT, (upto[-1] if len(upto) else 0) + LAID_OUT, LAID_OUT))
    lo = 0
    for hi in np.minimum(cuts + 1, len(sizes)):
        some = sizes[lo:hi]
        if some.sum():
            row = np.repeat(np.arange(lo, hi), some)
            yield row, np.arange(len(row)) + np.repeat(starts[lo:hi] - (upto[lo:hi] - some - upto[lo] + sizes[lo]), some)
        lo = hi


class _Scores:
    """Similarities of a block of queries (rows) with one of documents; exact to ``slack``, one number per query."""

    def __init__(self, about):
        self.about, self.slack = about, np.zeros(len(about))

    def exact(self, q, d):
        """The similarities of pairs."""
        return self.about[q, d]

    def rows(self, q):
        """Those of whole rows."""
        return self.about[q]


class _SparseScores(_Scores):
    def __init__(self, asked, docs):
        d_idx, d_off = _ragged(docs["indices"])
        d_val, _ = _ragged(docs["values"])
        place = asked.places(d_idx)
        known = place >= 0
        self.off = np.concatenate([[0], np.cumsum(known)])[d_off]
        self.place, self.value, self.asked = place[known], d_val[known], asked
        doc = np.repeat(np.arange(len(docs)), np.diff(self.off))
        column = asked.column[self.place]
        often = column >= 0
        width = asked.matrix.shape[1]
        matrix = np.bincount(doc[often] * width + column[often], self.value[often], len(docs) * width).reshape(len(docs), width)
        self.about = asked.matrix @ matrix.astype(np.float32).T
        term, of, value = self.place[~often], doc[~often], self.value[~often].astype(np.float32)
        for row, at in _laid_out(asked.sizes[term], asked.starts[term]):
            np.add.at(self.about.ravel(), asked.list_q[at] * len(docs) + of[row], value[row] * asked.list_value[at])
        longest = np.sqrt(np.bincount(doc, self.value**2, 1).max())
        self.slack = ERROR * longest * asked.length

    def exact(self, q, d):
        out = np.zeros(len(q))
        for pair, at in _laid_out(np.diff(self.off)[d], self.off[d]):
            lo, hi = pair[0], pair[-1] + 1
            out[lo:hi] = np.bincount(pair - lo, self.value[at] * self.asked.dense[self.place[at], q[pair]], hi - lo)
        return out

    def rows(self, q):
        dense, sims = self.asked.dense[:, q], np.zeros((len(self.off) - 1, len(q)))
        for row, (lo, hi) in enumerate(zip(self.off, self.off[1:])):
            if lo < hi:
                sims[row] = self.value[lo:hi] @ dense[self.place[lo:hi]]
        return sims.T


class _SparseQueries:
    """A block of queries: a dense table by term, its terms that many queries have as a matrix, and lists of the others."""

    def __init__(self, queries):
        q_idx, q_off = _ragged(queries["indices"])
        q_val, _ = _ragged(queries["values"])
        n = len(queries)
        self.terms, term = np.unique(q_idx, return_inverse=True)
        # entries in order of terms
        order = np.argsort(term, kind="stable")
        term, self.list_q = term[order], np.repeat(np.arange(n), np.diff(q_off))[order]
        value = q_val[order].astype(np.float64)
        self.list_value = value.astype(np.float32)
        self.length = np.sqrt(np.bincount(self.list_q, value**2, n))
        self.dense = np.zeros((len(self.terms), n))
        self.dense[term, self.list_q] = value
        self.sizes = np.bincount(term, minlength=len(self.terms))
        self.starts = np.cumsum(self.sizes) - self.sizes
        # as many of the most frequent terms in the matrix as make a pair cheapest
        order = np.argsort(-self.sizes, kind="stable")
        rest = np.append(np.cumsum((self.sizes[order][::-1] / max(n, 1)) ** 2)[::-1], 0.0)
        width = min(MATRIX_TERMS, key=lambda f: f * MATRIX_COST + rest[min(f, len(order))] * POSTING_COST)
        self.column = np.full(len(self.terms), -1)
        self.column[order[:width]] = np.arange(len(order[:width]))
        self.matrix = np.ascontiguousarray(self.dense[order[:width]].T, np.float32)

    def places(self, idx):
        """The rows of ``dense`` that belong to terms; -1 for terms that no query has."""
        place = np.searchsorted(self.terms, idx) if len(self.terms) else np.zeros(len(idx), np.int64)
        known = np.zeros(len(idx), bool)
        inside = place < len(self.terms)
        known[inside] = self.terms[place[inside]] == idx[inside]
        return np.where(known, place, -1)


def _sparse_scores(queries):
    """A function that gives the similarities of the queries (rows) with the documents of a block."""
    asked = _SparseQueries(queries)
    return lambda docs: _SparseScores(asked, docs)


def _unit_rows(column):
    flat, offsets = _ragged(column)
    rows = flat.reshape(len(offsets) - 1, -1).astype(np.float64)
    length = np.linalg.norm(rows, axis=1, keepdims=True)
    return np.divide(rows, length, out=np.zeros_like(rows), where=length > 0)


def _dense_scores(queries):
    q = _unit_rows(queries["embedding"])
    return lambda docs: _Scores(q @ _unit_rows(docs["embedding"]).T)


def _hashed_scores(queries):
    """As ``_dense_scores`` of the pairs that share a bucket in some table; -inf of the others."""
    score, asked = _dense_scores(queries), _buckets(queries)

    def scores(docs):
        known = _buckets(docs)
        met = np.zeros((len(asked), len(known)), bool)
        for table in range(asked.shape[1]):
            met |= asked[:, table, None] == known[None, :, table]
        return _Scores(np.where(met, score(docs).about, -np.inf))

    return scores


def _buckets(rows):
    return _ragged(rows["buckets"])[0].reshape(len(rows), -1)


def _best(docs, k, scores, bound):
    """(q, doc_id, sim): the k best documents of a block per query; ties by id. Those at -inf are no candidates.

    ``bound`` is what the k-th best of other documents reaches, per query; those below it may be left out.
    """
    about, n_docs = scores.about, len(docs)
    slack, limit = scores.slack + ROOM, bound - scores.slack - ROOM
    new = np.flatnonzero(np.isneginf(bound))
    if len(new) and n_docs > k:
        limit[new] = np.partition(about[new], n_docs - k, axis=1)[:, n_docs - k] - 2 * slack[new]
    # not above the limit when it is rounded
    limit = np.nextafter(np.maximum(limit, -1e30).astype(about.dtype), about.dtype.type(-np.inf))
    hit = about >= limit[:, None]
    # where many are as near, whole rows are cheaper
    broad = np.flatnonzero(np.count_nonzero(hit, axis=1) > max(4 * k, n_docs // 8))
    hit[broad] = False
    q, near = np.nonzero(hit)
    sims = scores.exact(q, near)
    if len(broad):
        low = -scores.rows(broad)
        if n_docs > k:
            kept = low <= np.partition(low, k - 1, axis=1)[:, k - 1 : k] + ROOM
        else:
            kept = np.ones(low.shape, bool)
        row, more = np.nonzero(kept & (low < np.inf))
        q, near, sims = np.append(q, broad[row]), np.append(near, more), np.append(sims, -low[row, more])
    sims = np.round(sims, DIGITS) + 0.0
    rank = np.empty(n_docs, np.int64)
    rank[pc.sort_indices(docs["doc_id"]).to_numpy()] = np.arange(n_docs)
    at = np.lexsort((rank[near], -sims, q))
    at = at[_places(q[at]) < k]
    return pa.table({"q": q[at], "doc_id": docs["doc_id"].take(pa.array(near[at])), "sim": sims[at]})


def _bound(best, n, k):
    """The k-th best similarity that each of n queries has so far; -inf where it has fewer."""
    out = np.full(n, -np.inf)
    if best is not None:
        counts = np.bincount(best["q"].to_numpy(), minlength=n)
        full = counts >= k
        out[full] = best["sim"].to_numpy()[np.cumsum(counts)[full] - 1]
    return out


def _places(q):
    """Place of every row among those of its query, from 0; ``q`` is sorted."""
    return np.arange(len(q)) - np.searchsorted(q, q)


def _merged(a, b, k):
    both = pa.concat_tables([a, b])
    both = both.take(pc.sort_indices(both, sort_keys=[("q", "ascending"), ("sim", "descending"), ("doc_id", "ascending")]))
    return both.filter(pa.array(_places(both["q"].to_numpy()) < k))


def _tasks(n, size, at_least=1):
    return max(at_least, math.ceil(n / size))


def _packed(df: DataFrame, columns: list[str], size: int, tasks: int, name: str) -> DataFrame:
    """(name, name_rows): blocks of at most ``size`` rows as Arrow streams, written once."""

    def pack(batches):
        part, number, waiting = TaskContext.get().partitionId(), 0, None
        for batch in batches:
            rows = pa.Table.from_batches([batch])
            waiting = rows if waiting is None else pa.concat_tables([waiting, rows])
            while len(waiting) >= size:
                yield packed(part, number, waiting.slice(0, size))
                number, waiting = number + 1, waiting.slice(size)
        if waiting is not None and len(waiting):
            yield packed(part, number, waiting)

    def packed(part, number, rows):
        sink = pa.BufferOutputStream()
        rows = rows.combine_chunks()
        with pa.ipc.new_stream(sink, rows.schema) as out:
            out.write_table(rows)
        return pa.RecordBatch.from_pydict({name: [f"{part}-{number}"], f"{name}_rows": pa.array([sink.getvalue().to_pybytes()], pa.binary())})

    blocks = df.select(columns).repartition(tasks).mapInArrow(pack, f"{name} string, {name}_rows binary")
    return staged(blocks, f"{name}-blocks")


def top_k(
    queries: DataFrame, corpus: DataFrame, k: int = P.TOP_K, dense: bool = False,
    exclude_self: bool = False, n_queries: int | None = None, n_docs: int | None = None,
) -> DataFrame:
    """(query_id, doc_id, sim, rank): the k nearest documents of every query.

    ``queries`` has query_id, ``corpus`` has doc_id; both carry ``indices`` and
    ``values`` (sparse, unit length) or ``embedding`` (dense).  Every query
    gets k rows while the corpus has k, at similarity 0 if need be; ties go
    to the smaller id.  ``n_queries`` and ``n_docs`` only size the blocks and
    are counted when not given.
    """
    data, scores = (["embedding"], _dense_scores) if dense else (["indices", "values"], _sparse_scores)
    return _top_k(queries, corpus, k, data, scores, exclude_self, n_queries, n_docs)


def _top_k(queries, corpus, k, data, scores, exclude_self, n_queries=None, n_docs=None):
    """``top_k`` of the similarities that ``scores`` finds in the columns ``data``."""
    n_queries = queries.count() if n_queries is None else n_queries
    n_docs = corpus.count() if n_docs is None else n_docs
    wanted = k + 1 if exclude_self else k
    held = HELD
    at_least = queries.sparkSession.sparkContext.defaultParallelism
    q = _packed(queries, ["query_id", *data], QUERY_BLOCK, _tasks(n_queries, QUERY_BLOCK), "asked")
    d = _packed(corpus, ["doc_id", *data], SLICE, _tasks(n_docs, DOC_BLOCK, at_least), "known")
    out = T.StructType(
        [
            T.StructField("query_id", queries.schema["query_id"].dataType),
            T.StructField("doc_id", corpus.schema["doc_id"].dataType),
            T.StructField("sim", T.DoubleType()),
        ]
    )

    def named(ids, best):
        rows = pa.table({"query_id": ids.take(best["q"]), "doc_id": best["doc_id"], "sim": best["sim"]})
        return rows.combine_chunks().to_batches()

    def kernel(batches):
        best, last, score = {}, None, None
        for batch in batches:
            names = batch.column(0).to_pylist()
            # a small table of queries comes whole with every block of documents: each block of queries is laid out once a batch
            for i in sorted(range(batch.num_rows), key=names.__getitem__):
                name = names[i]
                if name != last:
                    asked = pa.ipc.open_stream(batch.column(1)[i].as_buffer()).read_all()
                    last, score = name, scores(asked)
                    if name not in best and len(best) == held:
                        yield from named(*best.pop(next(iter(best))))
                docs = pa.ipc.open_stream(batch.column(3)[i].as_buffer()).read_all()
                ids, before = best.get(name) or (pa.array(asked["query_id"].to_pylist(), asked["query_id"].type), None)
                found = _best(docs, wanted, score(docs), _bound(before, len(ids), wanted))
                best[name] = ids, found if before is None else _merged(before, found, wanted)
        for pair in best.values():
            yield from named(*pair)

    near = q.crossJoin(d).mapInArrow(kernel, out)
    if exclude_self:
        near = near.filter(F.col("query_id") != F.col("doc_id"))
    order = Window.partitionBy("query_id").orderBy(F.desc("sim"), "doc_id")
    return near.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def approximate_top_k(
    queries: DataFrame, corpus: DataFrame, k: int = P.TOP_K, exclude_self: bool = False,
    bucket: float = P.LSH_BUCKET, tables: int = P.LSH_TABLES, seed: int = P.SEED,
) -> DataFrame:
    """(query_id, doc_id, sim, rank) by random projections: near vectors that share a bucket in some table (RET-2).

    The vectors are brought to unit length, so that near in distance is near in angle; those without length
    or with a null component take no part.  Pairs that share no bucket are missed; ``top_k`` with ``dense=True`` is exact.
    ``recall`` compares the two.
    """

    def unit(df, own_id):
        values = F.coalesce(F.transform("embedding", lambda x: x.cast("double")), F.array().cast("array<double>"))
        length = F.sqrt(F.aggregate(values, F.lit(0.0), lambda total, x: total + x * x))
        rows = df.select(F.col(own_id).alias("id"), values.alias("v"), length.alias("n")).filter("n > 0 AND n < double('inf')")
        length = F.when((F.col("n") > 0) & (F.col("n") < float("inf")), F.col("n")).otherwise(1.0)  # filters may come later
        # written, so that no vector is made of what the filter drops; rows that agree in id and vector are one
        rows = staged(rows.select("id", F.transform("v", lambda x: x / length).alias("v")).distinct(), "unit")
        return rows.withColumn("unit", array_to_vector("v"))

    # the model is random directions alone: of the rows, fitting reads the dimension
    known = unit(corpus, "doc_id")
    lsh = BucketedRandomProjectionLSH(inputCol="unit", outputCol="hashes", bucketLength=bucket, numHashTables=tables, seed=seed)
    model = lsh.fit(known)

    def hashed(rows, own_id):
        places = F.array(*(vector_to_array(F.get("hashes", F.lit(i)))[0].cast("long") for i in range(tables)))
        return model.transform(rows).select(F.col("id").alias(own_id), F.col("v").alias("embedding"), places.alias("buckets"))

    # a join on buckets would lay out every pair once per table they share; blocks hold a bit for each pair
    asked = hashed(unit(queries, "query_id"), "query_id")
    return _top_k(asked, hashed(known, "doc_id"), k, ["embedding", "buckets"], _hashed_scores, exclude_self)


def recall(found: DataFrame, exact: DataFrame) -> DataFrame:
    """One row: queries and neighbours of the exact result, and the share of these neighbours that was found."""
    hit = found.select("query_id", "doc_id", F.lit(1).alias("hit"))
    return exact.join(hit, ["query_id", "doc_id"], "left").agg(
        F.count_distinct("query_id").alias("n_queries"), F.count("*").alias("n_neighbours"),
        (F.count("hit") / F.count("*")).alias("recall"),
    )


def retrieve(
    cases: DataFrame, embeddings: DataFrame, sparse: Callable[[], DataFrame], dense: Callable[[], DataFrame],
    case_id: str = "case_id", vector_id: str = "case_id",
) -> DataFrame:
    """Neighbours by the representation that the stored vectors allow, and its ``method`` (RET-5).

    Dense only where every case has a vector and there are no others.  Only the plan that is chosen is built.
    """
    chosen = representation(cases, embeddings).first().method
    if chosen == "dense":
        ids = embeddings.select(F.col(vector_id).alias(case_id))
        if not cases.select(case_id).join(ids, case_id, "left_anti").isEmpty():
            chosen = "sparse"
    return (dense if chosen == "dense" else sparse)().withColumn("method", F.lit(chosen))


def with_solutions(neighbours: DataFrame, solutions: DataFrame) -> DataFrame:
    """Attach (doc_id, solution) to the neighbours (RET-4)."""
    return neighbours.join(solutions, "doc_id", "left").withColumn(
        "solution", F.coalesce("solution", F.lit(""))
    )


def representation(cases: DataFrame, embeddings: DataFrame) -> DataFrame:
    """Dense only where every case has its vector, else sparse (RET-5, SRC-4)."""
    n_vectors = embeddings.agg(F.count("*")).scalar()
    return cases.agg(F.count("*").alias("n_cases")).select(
        "n_cases",
        n_vectors.alias("n_vectors"),
        F.when((F.col("n_cases") == n_vectors) & (n_vectors > 0), "dense")
        .otherwise("sparse").alias("method"),
    )


def _seeded(id_col: str, seed: int):
    return F.md5(F.concat(F.col(id_col).cast("string"), F.lit(f":{seed}")))


def sampled_queries(
    test: DataFrame, n: int = P.N_QUERIES, seed: int = P.SEED,
    text=("ringkasan_fakta", "text_full"), chars: int = P.QUERY_CHARS,
) -> DataFrame:
    """n test cases in seeded hash order, with the first text that is not blank to ask with (RET-6)."""
    chosen = F.lit("")
    for column in reversed(text):
        chosen = F.when(blank_to_empty(F.col(column)) != "", F.col(column)).otherwise(chosen)
    return (
        test.orderBy(_seeded("case_id", seed), "case_id")
        .limit(n)
        .withColumn("query_id", F.concat(F.lit("q_"), F.substring("case_id", 1, 20)))
        .withColumn("query_text", F.substring(chosen, 1, chars))
    )


def expected_similar(queries: DataFrame, test: DataFrame, n: int = P.TOP_K) -> DataFrame:
    """(case_id, expected): up to n other test ids of the same label, by id (RET-7).

    n + 1 ids per label are enough for every query of that label, so a class
    that holds most rows is cut before it meets the queries.
    """
    place = F.row_number().over(Window.partitionBy("label").orderBy("other"))
    few = (
        test.select("label", F.col("case_id").alias("other"))
        .withColumn("place", place)
        .filter(F.col("place") <= n + 1)
    )
    pairs = queries.select("case_id", "label").join(few, "label", "left")
    other = F.when(F.col("other") != F.col("case_id"), F.col("other"))
    return pairs.groupBy("case_id").agg(
        F.slice(F.array_sort(F.collect_list(other)), 1, n).alias("expected")
    )


def ranked_ids(neighbours: DataFrame, name: str) -> DataFrame:
    """(query_id, ids): the neighbours' ids in rank order, k at most."""
    ranked = F.array_sort(F.collect_list(F.struct("rank", "doc_id")))
    return neighbours.groupBy("query_id").agg(
        F.transform(ranked, lambda x: x["doc_id"]).alias(name)
    )


def query_records(
    queries: DataFrame, expected: DataFrame, sparse: DataFrame, dense: DataFrame | None = None
) -> DataFrame:
    """Nested query records; the dense list is empty without dense vectors (RET-8)."""
    none = F.array().cast("array<string>")
    df = (
        queries.join(expected, "case_id", "left")
        .join(ranked_ids(sparse, "top5_tfidf"), "query_id", "left")
    )
    if dense is None:
        df = df.withColumn("top5_bert", none)
    else:
        df = df.join(ranked_ids(dense, "top5_bert"), "query_id", "left")
    return df.select(
        "query_id", "case_id", "no_perkara",
        F.col("label").alias("decision_type"),
        "query_text",
        F.col("case_id").alias("ground_truth_case_id"),
        F.coalesce("expected", none).alias("expected_similar_case_ids"),
        F.coalesce("top5_tfidf", none).alias("top5_tfidf"),
        F.coalesce("top5_bert", none).alias("top5_bert"),
    )
