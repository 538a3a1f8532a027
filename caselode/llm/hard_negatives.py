"""Hard negatives by anchor clusters that share candidate lists.

Anchors are clustered by angle. For a cluster with centre c whose members lie within the angle b of it, a candidate x at
the angle a from c scores at most |x| * cos(max(0, a - b)) with any member of unit length. The candidates are
sorted by that bound once per cluster, and every member walks the list until the bound certifies that no later
candidate can matter. The walk goes twice: for the positives of an anchor, which are its best rows of the same label, and for
the best rows of other labels in the window of scores below each positive.

Anchors come in blocks of bounded size, which are broadcast; the candidates stay where they are and are read once per
block and walk. Rows with equal vectors and labels are one class, of which only the smallest ids can be chosen. Clusters
are fitted on a bounded sample of the anchors; they only change how far a walk goes, never its result.
"""

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from caselode.session import staged

from .common import map_batches

#: Anchors that the clusters are fitted on at most, those with the smallest hash; clusters; rounds of fitting.
FIT_ANCHORS, CLUSTERS, FIT_ROUNDS = 8_192, 32, 8
#: Classes of anchors and numbers of their vectors in one block that is broadcast, at most.
BLOCK_ROWS, BLOCK_NUMBERS = 16_384, 2_000_000
#: Candidates of a list that are scored in one go, and scores held at once; below EXACT products are exact as doubles.
STRIDE, SCORES = 256, 1 << 21
EXACT = 2.0**53
LONG = 2**63 - 1


def quantised(vector: Column, scale: int = 256) -> Column:
    """floor(scale * x) of every component, as whole numbers."""
    return F.transform(vector, lambda x: F.floor(x.cast("double") * scale))


def usable(vector: Column) -> Column:
    """Whether a vector is there and all its components are finite."""
    odd = lambda x: x.isNull() | F.isnan(x) | (F.abs(x.cast("double")) == float("inf"))
    return vector.isNotNull() & ~F.exists(vector, odd)


# --- vectors of a batch ---------------------------------------------------------------


def _matrix(column, width):
    """Rows of a list column as whole numbers; rows with fewer than `width` end in zeros."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    flat = column.flatten().to_numpy(zero_copy_only=False)
    sizes = column.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
    whole = np.zeros((len(sizes), width), np.int64)
    row = np.repeat(np.arange(len(sizes)), sizes)
    whole[row, np.arange(len(flat)) - (np.cumsum(sizes) - sizes)[row]] = flat
    return whole


def _lengths(matrix):
    return np.sqrt((matrix.astype(np.float64) ** 2).sum(axis=1))


def _most(matrix):
    return float(np.abs(matrix.astype(np.float64)).max(initial=0))


def _unit(matrix):
    length = _lengths(matrix)[:, None]
    return np.divide(matrix, length, out=np.zeros(matrix.shape), where=length > 0)


def products(a, b):
    """Whole inner products of all rows of a with all rows of b; beyond a long they are cut to its range."""
    bound = _most(a) * _most(b) * max(1, a.shape[1])
    if bound < EXACT:
        return (a.astype(np.float64) @ b.astype(np.float64).T).astype(np.int64)
    if bound < 2.0**62:
        return a @ b.T
    return np.clip(a.astype(object) @ b.astype(object).T, -LONG, LONG).astype(np.int64)


# --- clusters -------------------------------------------------------------------------


def fitted_centres(vectors: np.ndarray, clusters: int = CLUSTERS, rounds: int = FIT_ROUNDS) -> np.ndarray:
    """Unit centres of clusters by angle; the first ones are chosen far from each other."""
    unit = _unit(vectors)[_lengths(vectors) > 0]
    if not len(unit):
        return np.zeros((1, vectors.shape[1]))
    nearest, chosen = np.full(len(unit), -2.0), [0]
    while len(chosen) < min(clusters, max(1, int(np.sqrt(len(unit))))):
        nearest = np.maximum(nearest, unit @ unit[chosen[-1]])
        chosen.append(int(nearest.argmin()))
    centres = unit[chosen]
    for _ in range(rounds):
        sums = np.zeros_like(centres)
        np.add.at(sums, (unit @ centres.T).argmax(axis=1), unit)
        length = np.linalg.norm(sums, axis=1, keepdims=True)
        centres = np.divide(sums, length, out=centres, where=length > 0)
    return centres


class Cluster:
    """Members of one cluster: their class keys, labels and vectors."""

    def __init__(self, centre, keys, labels, vectors):
        self.centre, self.keys, self.labels, self.vectors = centre, keys, labels, vectors
        self.length = _lengths(vectors)
        cosine = np.clip(_unit(vectors) @ centre, -1, 1)[self.length > 0]
        self.angle = float(np.arccos(cosine.min())) if len(cosine) else 0.0

    def bounds(self, vectors, length):
        """For every candidate the most that it can score with a member of length 1."""
        cosine = np.divide(vectors @ self.centre, length, out=np.ones(len(length)), where=length > 0)
        away = np.arccos(np.clip(cosine, -1, 1)) - self.angle
        return length * np.cos(np.clip(away, 0, np.pi)) + 1e-9 * length

    def least_of_own(self, most):
        """For every member a score that at least `most` rows of its label reach: the members themselves do."""
        out = np.full(len(self.keys), -LONG)
        for label in np.unique(self.labels):
            own = np.flatnonzero(self.labels == label)
            for some in np.array_split(own, max(1, len(own) ** 2 // SCORES)) if len(own) >= most else ():
                scores = products(self.vectors[some], self.vectors[own])
                out[some] = np.partition(scores, scores.shape[1] - most, axis=1)[:, -most]
        return out


class Walk:
    """The walk of a cluster's members along shared lists of candidates.

    A row is a member with a window [low, high] of scores, and wants the best `most` classes of its window with its
    own label (`same`) or another one; `at` are the rows' members, `mark` tells a member's windows apart.
    """

    def __init__(self, cluster, at, low, high, mark, same, most):
        self.given = cluster, at, low, high, mark, same, most
        self.cluster, self.at, self.low, self.high, self.mark, self.same, self.most = self.given
        self.need = low.copy()
        self.best = np.full((len(at), most), -LONG - 1)
        self.found, self.held, self.n_scored = [], 0, 0

    def along(self, labels, vectors, length, ids):
        """Walk the list of one batch of candidates, sorted by their bounds once for all rows."""
        cluster = self.cluster
        bounds = cluster.bounds(vectors, length)
        order = np.argsort(-bounds, kind="stable")
        going, at, reach = np.arange(len(self.at)), 0, cluster.length[self.at]
        while at < len(order):
            # a bound of just `need` may be a tie that a smaller id wins
            going = going[reach[going] * bounds[order[at]] + 1.0 >= self.need[going]]
            if not len(going):
                return  # certified: nothing later in the list can matter to any row
            some = order[at : at + max(16, min(STRIDE, SCORES // len(going)))]
            at += len(some)
            members, own = np.unique(self.at[going], return_inverse=True)
            scores = products(cluster.vectors[members], vectors[some])
            self.n_scored += scores.size
            fits = (cluster.labels[members][:, None] == labels[some][None, :]) == self.same
            if len(members) < len(going):
                scores, fits = scores[own], fits[own]
            fits &= (scores >= self.need[going][:, None]) & (scores <= self.high[going][:, None])
            r, c = np.nonzero(fits)
            if len(r):
                self._take(going, scores, fits, r, c, ids, some)

    def _take(self, going, scores, fits, r, c, ids, some):
        self.found.append((going[r], scores[r, c], ids[some[c]]))
        self.held += len(r)
        touched = np.unique(r)
        rows = going[touched]
        both = np.concatenate([self.best[rows], np.where(fits[touched], scores[touched], -LONG - 1)], axis=1)
        self.best[rows] = np.partition(both, both.shape[1] - self.most, axis=1)[:, -self.most :]
        self.need[rows] = np.maximum(self.low[rows], self.best[rows].min(axis=1))
        if self.held > 8 * self.most * len(self.at) + SCORES:
            self.found = [self.result()]
            self.held = len(self.found[0][0])

    def result(self):
        """(row, score, ids): the best classes of each row; of equal scores those with the smallest first ids."""
        if not self.found:
            return np.empty(0, np.int64), np.empty(0, np.int64), np.empty((0, 0), np.int64)
        r, s, ids = (np.concatenate(x) for x in zip(*self.found))
        keep = np.flatnonzero(s >= self.need[r])
        keep = keep[np.lexsort((ids[keep, 0], -s[keep], r[keep]))]
        r, s, ids = r[keep], s[keep], ids[keep]
        first = np.arange(len(r)) - np.searchsorted(r, r) < self.most
        return r[first], s[first], ids[first]


# --- the operator ---------------------------------------------------------------------

#: Stands for no id in the fixed-width ids of a class.
_NONE = np.iinfo(np.int64).max


def _walked(classes: DataFrame, walks: list[Walk], width: int, n_ids: int) -> DataFrame:
    """(key, mark, score, id): what the rows of the walks find among the classes, best of each task."""
    shared = classes.sparkSession.sparkContext.broadcast(walks)

    def run(batches):
        own = [Walk(*w.given) for w in shared.value]
        for batch in batches:
            vectors = _matrix(batch.column("v"), width)
            ids = _matrix(batch.column("ids"), n_ids)
            ids[np.arange(n_ids)[None, :] >= batch.column("ids").value_lengths().to_numpy()[:, None]] = _NONE
            length = _lengths(vectors)
            for w in own:
                w.along(batch.column("label").to_numpy(), vectors, length, ids)
        for w in own:
            r, s, ids = w.result()
            for a in range(0, len(r), 20_000):
                rows, wide = r[a : a + 20_000], ids[a : a + 20_000]
                there = wide != _NONE
                repeat = there.sum(axis=1)
                yield pa.RecordBatch.from_pydict({
                    "key": np.repeat(w.cluster.keys[w.at[rows]], repeat), "mark": np.repeat(w.mark[rows], repeat),
                    "score": np.repeat(s[a : a + 20_000], repeat), "id": wide[there],
                })

    return classes.select("label", "v", "ids").mapInArrow(run, "key long, mark long, score long, id long")


def _blocks(members: DataFrame, width: int) -> list[list[tuple[int, int, int]]]:
    """Lists of (cluster, piece, pieces): what is broadcast together; large clusters are cut by hash of the key."""
    size = max(256, min(BLOCK_ROWS, BLOCK_NUMBERS // max(1, width)))
    blocks, room = [], 0
    for cluster, n in sorted(tuple(r) for r in members.groupBy("cluster").count().collect()):
        pieces = -(-n // size)
        for piece in range(pieces):
            if room < n / pieces or not blocks:
                blocks.append([])
                room = size
            blocks[-1].append((cluster, piece, pieces))
            room -= n / pieces
    return blocks


def _block(members: DataFrame, block) -> DataFrame:
    wanted = F.lit(False)
    for cluster, piece, pieces in block:
        wanted |= (F.col("cluster") == cluster) & (F.pmod(F.xxhash64("key"), F.lit(pieces)) == piece)
    return members.filter(wanted)


def _clusters(rows, centres, width):
    """(cluster, positions of its members) of a collected block."""
    own = rows.column("cluster").to_numpy()
    keys, labels = rows.column("key").to_numpy(), rows.column("label").to_numpy()
    vectors = _matrix(rows.column("v"), width)
    for c in np.unique(own):
        at = np.flatnonzero(own == c)
        yield Cluster(centres[c], keys[at], labels[at], vectors[at]), at


def _united(parts: list[DataFrame]) -> DataFrame:
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def _first(df: DataFrame, group: list[str], n: int) -> DataFrame:
    """`place` 1 to n: the best rows of each group by score, then id; most are dropped before the shuffle."""
    order = Window.partitionBy(*group).orderBy(F.desc("score"), "id")
    return df.withColumn("place", F.row_number().over(order)).filter(F.col("place") <= n)


def mine(
    vectors: DataFrame, anchor: Column, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label",
    label: Column | None = None, positives: int = 5, negatives: int = 5, low: int = 80, high: int = 100,
) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score) of all anchors that have some.

    Scores are inner products of the vectors as whole numbers. A positive of an anchor is one of its `positives` best other
    rows of the same label; its negatives are the best rows of other labels from `low` to `high` per cent of its score. Ties
    go to the smaller id. Rows without id or label, without vector, or with a component that is null, not a number or
    infinite take no part. Repeated rows count once; rows of one id with other vectors are candidates of their own,
    but no positives of that id. Shorter vectors end in zeros; scores beyond a long are cut to its range. An empty
    table gives no rows; other columns are not read. Ids and labels are whole numbers; `label` replaces the column.
    """
    spark = vectors.sparkSession
    rows = vectors.filter(usable(F.col(f"`{vector_col}`"))).select(
        F.col(f"`{id_col}`").cast("long").alias("id"), quantised(F.col(f"`{vector_col}`")).alias("v"),
        (F.col(f"`{label_col}`") if label is None else label).cast("long").alias("label"),
        F.coalesce(anchor, F.lit(False)).alias("asks"),
    ).filter("id IS NOT NULL AND label IS NOT NULL")
    rows = staged(rows.distinct(), "negatives-rows")
    n_ids = max(positives + 1, negatives)
    order = Window.partitionBy("label", "v").orderBy("id")
    some = rows.select("label", "v", "id").distinct().withColumn("place", F.row_number().over(order))
    classes = some.filter(F.col("place") <= n_ids).groupBy("label", "v").agg(F.array_sort(F.collect_list("id")).alias("ids"))
    classes = staged(classes.withColumn("key", F.monotonically_increasing_id()), "negatives-classes")
    asked = rows.filter("asks").select(F.col("id").alias("anchor_id"), "label", "v").join(classes.drop("ids"), ["label", "v"])
    asked = staged(asked, "negatives-anchors")
    sizes = classes.agg(F.max(F.size("v"))).first()[0]
    width = max(1, sizes or 0)
    sample = asked.dropDuplicates(["key"]).orderBy(F.xxhash64("key"), "key").limit(FIT_ANCHORS).select("v").toArrow()
    out = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
    if not sample.num_rows:
        return spark.createDataFrame([], out)
    centres = fitted_centres(_matrix(sample.column("v"), width))

    def assign(batch):
        unit = _unit(_matrix(batch.column("v"), width))
        columns = {c: batch.column(c) for c in ("key", "label", "v")}
        yield columns | {"cluster": (unit @ centres.T).argmax(axis=1).astype(np.int32)}

    members = map_batches(
        asked.dropDuplicates(["key"]).select("key", "label", "v"), assign, "key long, label long, v array<bigint>, cluster int"
    )
    members = staged(members, "negatives-members")
    blocks, found = _blocks(members, width), []
    for block in blocks:
        walks = []
        for cluster, at in _clusters(_block(members, block).toArrow(), centres, width):
            least = cluster.least_of_own(positives + 1)
            each, none = np.arange(len(at)), np.zeros(len(at), np.int64)
            walks.append(Walk(cluster, each, least, none + LONG, none, True, positives + 1))
        found.append(staged(_walked(classes, walks, width, n_ids), "negatives-near"))
    near = staged(_first(_united(found), ["key"], positives + 1).drop("mark"), "negatives-positives")
    windows = near.groupBy("key").agg(F.collect_set("score").alias("scores"))
    windows = staged(members.join(windows, "key"), "negatives-windows")
    found = []
    for block in blocks:
        rows_of_block = _block(windows, block).toArrow()
        scores, walks = rows_of_block.column("scores").to_pylist(), []
        for cluster, at in _clusters(rows_of_block, centres, width):
            window = [(k, -(-low * s // 100), s * high // 100, s) for k, i in enumerate(at) for s in scores[i]]
            window = [w for w in window if w[1] <= w[2]]
            if window:
                k, least, most, mark = (np.array(x, np.int64) for x in zip(*window))
                walks.append(Walk(cluster, k, least, most, mark, False, negatives))
        found.append(staged(_walked(classes, walks, width, n_ids), "negatives-far"))
    far = _first(_united(found), ["key", "mark"], negatives)
    far = far.groupBy("key", "mark").agg(F.array_sort(F.collect_list(F.struct("place", "id", "score"))).alias("far"))
    near = near.withColumn("mark", F.col("score")).join(far, ["key", "mark"], "left")
    answers = near.groupBy("key").agg(
        F.array_sort(F.collect_list(F.struct("place", "id", "score", "far"))).alias("answers")
    )
    own = F.slice(F.filter("answers", lambda x: x["id"] != F.col("anchor_id")), 1, positives)
    chosen = asked.select("anchor_id", "key").join(answers, "key").select("anchor_id", F.explode(own).alias("p"))
    chosen = chosen.select("anchor_id", "p", F.explode("p.far").alias("n"))
    return chosen.select(
        "anchor_id", F.col("p.id").alias("positive_id"), F.col("n.place").cast("int").alias("rank"),
        F.col("n.id").alias("negative_id"), F.col("p.score").alias("positive_score"), F.col("n.score").alias("negative_score"),
    )
