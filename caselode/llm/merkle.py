"""Merkle manifest of a dataset by time-forward processing.

Every row is a leaf. The leaves of a group, in order, are joined in runs of 16 to parents, those again, until one node
is left: the group's subroot. The subroots, in order of the groups, make the tree above in the same way.

A node's label is (last leaf below it, level), so children come before their parent. Digests are messages to the parent's
label. The priority queue that holds them is external: Spark deals the nodes out by blocks of 16**2 neighbours
and sorts them by label, spilling where it must; inside a task a heap holds the messages to nodes that are still open, at
most 16 on each of two levels. What a block's top node sends is delivered in the next round. The reversed sweep goes
through the same labels backwards: a parent hands each child the runs on its way to the root, and a leaf that has got them
has its proof. A task reads a sorted stream and holds a few hundred digests, whatever the size of a group.
"""

import heapq
from dataclasses import dataclass
from hashlib import sha256

import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from caselode.session import staged

#: Nodes that become one parent, and levels that one round goes up.
RUN, LEVELS = 16, 2
BLOCK = RUN**LEVELS
#: Columns of a leaf, in the order in which they are hashed.
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
DIGEST = 64
#: Level of the message that a whole block gets; above that of any node in it.
_ABOVE = LEVELS + 1

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def digest(data: bytes) -> bytes:
    """Lowercase hex of the hash; digests are hashed as hex text."""
    return sha256(data).hexdigest().encode()


def height(n: int) -> int:
    """Levels above n nodes until one is left."""
    levels = 0
    while n > 1:
        n, levels = -(-n // RUN), levels + 1
    return levels


def leaf_digest(columns: list[Column]) -> Column:
    """Hash of the fields of a row; each is `-` if null, else its UTF-8 byte count, a colon and its value."""
    fields = [c.cast("string") for c in columns]
    written = [F.when(c.isNull(), "-").otherwise(F.concat(F.octet_length(c).cast("string"), F.lit(":"), c)) for c in fields]
    return F.sha2(F.concat(*written), 256)


def lowered(c: Column) -> Column:
    """A-Z as a-z, all else as it is."""
    return F.translate(c, _UPPER, _LOWER)


@dataclass
class Manifest:
    """The trees of a dataset as tables.

    leaves: (tree, idx, n, id, leaf, tampered), idx from 0 in the group's n leaves; groups: (tree, grp, n, subroot);
    runs and group_runs: for each round the inner nodes (tree, block, level, number, n, run, top), where run holds the
    digests of a node's children; root: None without any leaf.
    """

    leaves: DataFrame
    groups: DataFrame
    runs: list[DataFrame]
    group_runs: list[DataFrame]
    root: str | None


# --- places ---------------------------------------------------------------------------


def _tasks(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def _ranged(df: DataFrame, by: list[str], name: str) -> DataFrame:
    """The rows written in order of `by`; `order` grows with the place, `part` is the task that wrote the row."""
    rows = df.repartitionByRange(_tasks(df.sparkSession), *by).sortWithinPartitions(*by)
    rows = rows.withColumn("order", F.monotonically_increasing_id())
    return staged(rows.withColumn("part", F.shiftright("order", 33)), name)


def _numbered(df: DataFrame, by: str, name: str) -> DataFrame:
    """`tree`: the number of a row in the order of `by`, from 0."""
    rows = _ranged(df, [by], name)
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # one row per part
    parts = rows.groupBy("part").agg(F.count("*").alias("m"), F.min("order").alias("first"))
    parts = parts.select("part", "first", F.coalesce(F.sum("m").over(before), F.lit(0)).alias("before"))
    numbered = rows.join(F.broadcast(parts), "part")  # as many rows as tasks
    return numbered.withColumn("tree", F.col("before") + F.col("order") - F.col("first")).drop("part", "order", "first", "before")


def _placed(leaves: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Leaves with the number of their group and their place in it, and (tree, grp, n) of all groups.

    The rows of a group in one part are counted together: a group that has most rows is one row per part.
    """
    rows = _ranged(leaves, ["grp", "id", "leaf", "salt"], "merkle-ordered")
    spans = rows.groupBy("part", "grp").agg(F.count("*").alias("m"), F.min("order").alias("first"))
    spans = staged(spans, "merkle-spans")
    groups = _numbered(spans.groupBy("grp").agg(F.sum("m").alias("n")), "grp", "merkle-groups")
    groups = staged(groups.select("tree", "grp", "n"), "merkle-trees")
    before = Window.partitionBy("grp").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    spans = spans.withColumn("before", F.coalesce(F.sum("m").over(before), F.lit(0)))
    own = spans.alias("s").join(groups.alias("g"), F.col("s.grp").eqNullSafe(F.col("g.grp")))
    own = own.select("part", F.col("s.grp").alias("grp"), "first", "before", "tree", "n")
    placed = rows.alias("r").join(
        own.alias("o"), (F.col("r.part") == F.col("o.part")) & F.col("r.grp").eqNullSafe(F.col("o.grp"))
    )
    idx = F.col("before") + F.col("order") - F.col("first")
    return staged(placed.select("tree", idx.alias("idx"), "n", "id", "leaf", "tampered"), "merkle-placed"), groups


# --- sweeps ---------------------------------------------------------------------------


def _last(level, number, n):
    """The last of the n nodes of level 0 that lie below a node."""
    return min((number + 1) * RUN**level, n) - 1


def _sweep(rows):
    """All nodes above the rows of each block, LEVELS levels up or to the top of a smaller tree.

    Rows (tree, idx, n, digest) come in order of tree and idx, whole blocks at a time. The queue holds messages
    ((tree, last leaf, level) of the parent, number of the child, digest).
    """
    queue = []
    for tree, idx, n, own in rows:
        top = min(LEVELS, height(n))
        heapq.heappush(queue, ((tree, _last(1, idx // RUN, n), 1), idx, own))
        while queue and queue[0][0][:2] == (tree, idx):  # the last leaf below this node has come
            label, number, run = queue[0][0], queue[0][1] // RUN, []
            while queue and queue[0][0] == label:
                run.append(heapq.heappop(queue)[2])
            level, run = label[2], b"".join(run)
            yield tree, idx // BLOCK, level, number, n, run, level == top
            if level < top:
                above = level + 1
                heapq.heappush(queue, ((tree, _last(above, number // RUN, n), above), number, digest(run)))


def _sweep_back(rows):
    """(row, way to the root) of all rows of level 0; a way is (place in the run, run, way of the parent), or None.

    Rows have tree, block, level, number, n and message, in falling order of labels: of each block first the way of
    its top, then the inner nodes, each before its children. The queue holds the ways under the labels that they go to.
    """
    queue, given = [], None
    for row in rows:
        tree, block, level, number, n, message = row[:6]
        if level == _ABOVE:
            given = _unpacked(message)
            continue
        label = (-_last(level, number, n), -level)
        if queue and queue[0][0] == label:
            way = heapq.heappop(queue)[2]
        else:  # the block's top
            way = given
        if level == 0:
            yield row, way
            continue
        for place in range(len(message) // DIGEST):
            child = number * RUN + place
            to = (-_last(level - 1, child, n), 1 - level)
            heapq.heappush(queue, (to, child, (place, message, way)))


def _packed(way) -> bytes:
    out = []
    while way is not None:
        place, run, way = way
        out += [bytes((place, len(run) // DIGEST)), run]
    return b"".join(out)


def _unpacked(data: bytes):
    steps, at = [], 0
    while at < len(data):
        end = at + 2 + data[at + 1] * DIGEST
        steps.append((data[at], data[at + 2 : end]))
        at = end
    way = None
    for place, run in reversed(steps):
        way = (place, run, way)
    return way


def proof_digest(way) -> bytes:
    """Hash of all siblings, level by level, left to right."""
    h = sha256()
    while way is not None:
        place, run, way = way
        h.update(run[: place * DIGEST])
        h.update(run[(place + 1) * DIGEST :])
    return h.hexdigest().encode()


def folded(own: bytes, way) -> bytes:
    """The root that follows from a leaf and its siblings."""
    while way is not None:
        place, run, way = way
        own = digest(run[: place * DIGEST] + own + run[(place + 1) * DIGEST :])
    return own


#: What a backward sweep reads of a row, in this order.
_SWEPT = ["tree", "block", "level", "number", "n", "message"]


def _rows(batches, columns):
    for batch in batches:
        yield from zip(*(batch.column(c).to_pylist() for c in columns))


def _batches(rows, schema, size=2048):
    """Record batches of tuples in the order of an Arrow schema."""
    held = []

    def batch():
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), schema)], schema=schema)

    for row in rows:
        held.append(row)
        if len(held) == size:
            yield batch()
            held = []
    if held:
        yield batch()


def _stream(df: DataFrame, function, schema: str) -> DataFrame:
    """`function` takes an iterator over the rows of a task as tuples and yields tuples."""
    arrow, columns = to_arrow_schema(T._parse_datatype_string(schema)), df.columns
    return df.mapInArrow(lambda batches: _batches(function(_rows(batches, columns)), arrow), schema)


def _by_block(df: DataFrame, *order) -> DataFrame:
    """The external queue: whole blocks in one task, in the order of their labels."""
    rows = df.repartition(_tasks(df.sparkSession), "tree", "block")
    return rows.sortWithinPartitions("tree", "block", *order)


# --- rounds ---------------------------------------------------------------------------


def _climb(nodes: DataFrame, name: str) -> tuple[list[DataFrame], DataFrame]:
    """The runs of each round above nodes (tree, idx, n, digest), and (tree, digest) of the tops of all trees."""
    runs, tops = [], nodes.filter("n = 1").select("tree", "digest")
    most = nodes.agg(F.max("n")).first()[0] or 0
    nodes = nodes.filter("n > 1")
    while most > 1:
        dealt = nodes.select("tree", "idx", "n", F.encode("digest", "utf-8").alias("digest"), F.expr(f"idx div {BLOCK}").alias("block"))
        ordered = _by_block(dealt, "idx").drop("block")
        made = _stream(ordered, _sweep, "tree long, block long, level int, number long, n long, run binary, top boolean")
        made = staged(made, f"{name}-{len(runs)}")
        runs.append(made)
        up = made.filter("top").select("tree", F.col("block").alias("idx"), "n", F.sha2("run", 256).alias("digest"))
        tops = tops.unionByName(up.filter(f"n <= {BLOCK}").select("tree", "digest"))
        nodes = up.filter(f"n > {BLOCK}").withColumn("n", F.expr(f"(n + {BLOCK - 1}) div {BLOCK}"))
        most = -(-most // BLOCK) if most > BLOCK else 1
    return runs, tops


def _descend(runs: list[DataFrame], tops: DataFrame, nodes: DataFrame, name: str) -> DataFrame:
    """The nodes of level 0 in the order of the last backward sweep, met by their trees' runs and ways.

    tops: (tree, n, message), the way of each tree's top; nodes: (tree, idx, n, ...). A tree enters in the round
    that its top was made in; the rounds above the first are swept here.
    """
    enters = F.lit(0)
    for i in range(1, len(runs)):
        enters = enters + (F.col("n") > BLOCK**i).cast("int")
    tops = tops.select("tree", F.lit(0).cast("long").alias("block"), "message", enters.alias("enters"))
    ways = None
    for i in range(len(runs) - 1, 0, -1):
        own = tops.filter(F.col("enters") == i).drop("enters")
        ways = own if ways is None else ways.unionByName(own)
        below = runs[i - 1].filter(f"top and n > {BLOCK}")
        below = below.select("tree", F.col("block").alias("idx"), F.expr(f"(n + {BLOCK - 1}) div {BLOCK}").alias("n"))
        ways = _stream(_met(runs[i], ways, below).select(_SWEPT), _ways, "tree long, block long, message binary")
        ways = staged(ways, f"{name}-{i}")
    own = tops.filter("enters = 0").drop("enters")
    return _met(runs[0] if runs else None, own if ways is None else ways.unionByName(own), nodes)


def _ways(rows):
    for row, way in _sweep_back(rows):
        yield row[0], row[3], _packed(way)


def _met(runs: DataFrame | None, ways: DataFrame, nodes: DataFrame) -> DataFrame:
    """Ways of the tops, inner nodes and nodes of level 0 of a round, by block and in falling order of labels."""
    extra = [c for c in nodes.columns if c not in ("tree", "idx", "n")]
    none = F.lit(None)
    rows = nodes.select(
        "tree", F.expr(f"idx div {BLOCK}").alias("block"), F.lit(0).alias("level"), F.col("idx").alias("number"),
        "n", none.cast("binary").alias("message"), *extra,
    )
    given = ways.select(
        "tree", "block", F.lit(_ABOVE).alias("level"), F.lit(0).cast("long").alias("number"),
        none.cast("long").alias("n"), "message",
    )
    rows = rows.unionByName(given, allowMissingColumns=True)
    if runs is not None:
        inner = runs.select("tree", "block", "level", "number", "n", F.col("run").alias("message"))
        rows = rows.unionByName(inner, allowMissingColumns=True)
    after = F.lit(2**62)
    for level in range(_ABOVE):
        after = F.when(F.col("level") == level, F.least((F.col("number") + 1) * RUN**level, "n")).otherwise(after)
    return _by_block(rows, after.desc(), F.desc("level"))


# --- the operator ---------------------------------------------------------------------


def build(
    docs: DataFrame, id_col: str = "doc_id", group_col: str = "source", fields: tuple[str, ...] = FIELDS,
    changed: dict[str, Column] | None = None, when: Column | None = None,
) -> Manifest:
    """The manifest of a table.

    Leaves of a group are ordered by id, then digest; a null id comes first, and rows without a group are a group, the
    first one. A null field is hashed as `-`, so it differs from an empty one. Rows that repeat are leaves of their own.
    An empty table has no root. Columns that are not fields are not read; long texts are hashed whole, in the JVM.

    `changed` gives other values to fields of the rows `when` holds for, the tampered rows; their other
    digest is kept beside the original one, for `proofs`.
    """
    plain = [F.col(f"`{c}`") for c in fields]
    other = F.lit(None).cast("string")
    if changed:
        other = F.when(when, leaf_digest([changed.get(c, F.col(f"`{c}`")) for c in fields]))
    leaves = docs.select(
        F.col(f"`{group_col}`").alias("grp"), F.col(f"`{id_col}`").alias("id"), leaf_digest(plain).alias("leaf"),
        other.alias("tampered"), F.monotonically_increasing_id().alias("salt"),
    )
    placed, groups = _placed(staged(leaves, "merkle-leaves"))
    runs, tops = _climb(placed.withColumnRenamed("leaf", "digest"), "merkle-runs")
    groups = staged(groups.join(tops.withColumnRenamed("digest", "subroot"), "tree"), "merkle-subroots")
    n_groups = groups.count()
    nodes = groups.select(
        F.lit(0).cast("long").alias("tree"), F.col("tree").alias("idx"), F.lit(n_groups).cast("long").alias("n"),
        F.col("subroot").alias("digest"),
    )
    group_runs, top = _climb(nodes, "merkle-group-runs")
    first = top.first()
    return Manifest(placed, groups, runs, group_runs, first.digest if first else None)


def proofs(manifest: Manifest, with_siblings: bool = False) -> DataFrame:
    """(id, grp, leaf, subroot, root, proof_sha256, folded_root, verified) of every leaf.

    folded_root follows from the tampered leaf, where there is one, and the original siblings. `with_siblings` adds
    the proof itself: (place, run) from the leaf's run to the root's, where run holds the digests of a whole run.
    """
    spark, root = manifest.leaves.sparkSession, (manifest.root or "").encode()
    n_groups = manifest.groups.count()
    zero = F.lit(0).cast("long")
    top = spark.range(1).select(zero.alias("tree"), F.lit(n_groups).cast("long").alias("n"), F.lit(b"").alias("message"))
    nodes = manifest.groups.select(zero.alias("tree"), F.col("tree").alias("idx"), F.lit(n_groups).cast("long").alias("n"))
    met = _descend(manifest.group_runs, top, nodes, "merkle-group-ways")
    ways = _stream(met.select(_SWEPT), lambda rows: ((row[3], _packed(way)) for row, way in _sweep_back(rows)), "tree long, message binary")
    tops = manifest.groups.join(staged(ways, "merkle-ways"), "tree").select("tree", "n", "message")
    met = _descend(manifest.runs, tops, manifest.leaves, "merkle-ways")

    def prove(rows):
        for row, way in _sweep_back(rows):
            own, tampered = row[7], row[8]
            found = folded((own if tampered is None else tampered).encode(), way)
            yield row[0], row[6], own, proof_digest(way), found, found == root, _listed(way) if with_siblings else None

    id_type = manifest.leaves.schema["id"].dataType.simpleString()
    schema = (
        f"tree long, id {id_type}, leaf string, proof_sha256 string, folded_root string, verified boolean, "
        "proof array<struct<place:int,run:array<string>>>"
    )
    out = _stream(met.select(*_SWEPT, "id", "leaf", "tampered"), prove, schema)
    out = out.join(manifest.groups.select("tree", "grp", "subroot"), "tree")
    return out.select(
        "id", "grp", "leaf", "subroot", F.lit(manifest.root).cast("string").alias("root"), "proof_sha256", "folded_root", "verified",
        *["proof"] * with_siblings,
    )


def _listed(way) -> list:
    out = []
    while way is not None:
        place, run, way = way
        run = run.decode()
        out.append({"place": place, "run": [run[i : i + DIGEST] for i in range(0, len(run), DIGEST)]})
    return out


# --- files ----------------------------------------------------------------------------


def save(manifest: Manifest, path: str) -> None:
    """The manifest as Parquet tables in a folder that must not hold any yet."""
    spark = manifest.leaves.sparkSession
    manifest.leaves.write.parquet(f"{path}/leaves")
    manifest.groups.write.parquet(f"{path}/groups")
    for name, rounds in (("runs", manifest.runs), ("group_runs", manifest.group_runs)):
        for i, run in enumerate(rounds):
            run.write.parquet(f"{path}/{name}/round={i}")
    about = [(len(manifest.runs), len(manifest.group_runs), manifest.root)]
    spark.createDataFrame(about, "rounds int, group_rounds int, root string").coalesce(1).write.parquet(f"{path}/root")


def load(spark: SparkSession, path: str) -> Manifest:
    """A manifest that `save` has written; `root` is written last, so without it the folder is not whole."""
    try:
        about = spark.read.parquet(f"{path}/root").first()
    except AnalysisException as e:
        raise FileNotFoundError(f"{path} holds no whole manifest") from e
    rounds = lambda name, n: [spark.read.parquet(f"{path}/{name}/round={i}") for i in range(n)]
    return Manifest(
        spark.read.parquet(f"{path}/leaves"), spark.read.parquet(f"{path}/groups"),
        rounds("runs", about.rounds), rounds("group_runs", about.group_rounds), about.root,
    )
