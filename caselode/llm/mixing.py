"""Mixing sources to target weights by weighted fair queueing.

Every source is a queue of its documents in shuffled order, served at a rate in proportion to its
target. A document's virtual finish time is its source's words up to its end, divided by the
source's target; with targets that add up to the budget, the budget is used up at virtual time 1.
A queue that ends before is served again from its start. The documents of all sources are sorted by
finish time, their words are added up in that order, and the order is cut where the budget is used
up. What each source has in service at the cut is truncated, so every source gives its target to the word.
"""

import functools

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from caselode.session import staged

from . import words as w
from .common import map_batches, numbered_copies

#: Weights of the sources in code-point order, repeating; share of all words; most copies.
WEIGHTS = (5, 2, 1)
SHARE = 1.5
COPIES = 2
SEED = 17
#: Rows that agree in id, source and text are made again in runs of so many.
RUN = 4_096

_TABLE = w.space_words()


def with_sizes(docs: DataFrame, columns: dict[str, str], text_col="text") -> DataFrame:
    """Some columns of `docs`, under given names, the number of words of each text, and its hash, `mark`."""

    text = columns.get(text_col, "_text")

    def measure(batch):
        for a, b, data, borders in w.pieces(batch.column(text)):
            own = {name: batch.column(name)[a:b] for name in kept}
            yield own | {"size": w.Words(data, borders, _TABLE).count}

    kept = [*columns.values(), "mark"]
    chosen = docs.select(
        *[F.col(f"`{c}`").alias(name) for c, name in ({text_col: text} | columns).items()],
        F.xxhash64(F.col(f"`{text_col}`")).alias("mark"),
    )
    fields = ", ".join(f"{n} {chosen.schema[n].dataType.simpleString()}" for n in kept)
    return map_batches(chosen, measure, f"{fields}, size long")


def ranked(df: DataFrame, key: str) -> DataFrame:
    """`df` with `rank`, from 0, in the order of distinct keys, nulls last, without one task for all."""
    by_range = df.repartitionByRange(F.col(key).asc_nulls_last()).withColumn("part", F.spark_partition_id())
    parts = staged(by_range, "ranges")
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    # one row per partition of the range sort
    offsets = parts.groupBy("part").count().select(
        "part", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("offset")
    )
    own = Window.partitionBy("part").orderBy(F.col(key).asc_nulls_last())
    return (
        parts.join(offsets, "part").withColumn("rank", F.col("offset") + F.row_number().over(own) - 1)
        .drop("part", "offset")
    )


def targets(sizes: DataFrame, weights=WEIGHTS, share=SHARE, copies=COPIES) -> DataFrame:
    """(source, source_size, target) of `sizes` (source, size).

    The budget is `share` of all words, dealt by weight. A source gets at most `copies` times its
    size; what is over is dealt again by weight among the others until none is above.
    """
    totals = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    n = F.lit(len(weights))
    weight = F.element_at(F.array(*map(F.lit, weights)), (F.col("rank") % n + 1).cast("int"))
    sources = staged(ranked(totals, "source").select("source", "source_size", weight.alias("weight")), "sources")
    total, everything = sources.agg(F.sum("source_size"), F.sum("weight")).first()
    budget = share * (total or 0)
    most = F.col("source_size") * copies
    rate, capped = budget / (everything or 1), 0
    while True:
        over = F.col("weight") * F.lit(rate) > most
        full, n_over, rest = sources.agg(
            F.sum(F.when(over, most)), F.count_if(over), F.sum(F.when(~over, F.col("weight")))
        ).first()
        if not n_over or n_over == capped or not rest:
            break
        rate, capped = (budget - full) / rest, n_over
    return sources.select(
        "source", "source_size",
        F.least(F.col("weight") * F.lit(float(rate)), most.cast("double")).alias("target"),
    )


def shuffle_key(id_col: str, mark_col="mark", seed=SEED) -> Column:
    """Place in the shuffled order; rows without an id are shuffled by their texts."""
    name = F.coalesce(F.col(id_col).cast("string"), F.concat(F.lit("null:"), F.col(mark_col).cast("string")))
    return F.md5(F.concat(name, F.lit(f":{seed}")))


def _alike(a: str, b: str, names) -> Column:
    return functools.reduce(lambda x, y: x & y, [F.col(f"{a}.{n}").eqNullSafe(F.col(f"{b}.{n}")) for n in names])


def queue(sizes: DataFrame, goal: DataFrame, seed=SEED) -> DataFrame:
    """The queues: one row per source, id, mark and size of `sizes`, with `copies` (rows that agree in them),
    source_size, target, and `before`: words of the source's earlier documents in shuffled order.

    Rows that agree are next to each other, so the k-th of them has `before` + k * size words ahead. The
    order is a range sort over all sources; running sums go range by range, then inside each range, so neither a
    source with most of all documents nor an id or a text that many rows share meets in one task.
    """
    classes = sizes.groupBy("source", "id", "mark", "size").agg(F.count("*").alias("copies"))
    place = ("source", "key", "mark", "size")
    ranges = staged(
        classes.withColumn("key", shuffle_key("id", seed=seed)).repartitionByRange(*place)
        .withColumn("part", F.spark_partition_id()), "queue",
    )
    words = F.col("size") * F.col("copies")
    earlier = Window.partitionBy("source").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    plan = (
        ranges.groupBy("source", "part").agg(F.sum(words).alias("words"))
        .withColumn("offset", F.coalesce(F.sum("words").over(earlier), F.lit(0))).alias("o")
        .join(goal.alias("g"), _alike("o", "g", ["source"]))
        .select("o.source", "o.part", "offset", "source_size", "target")
    )
    inside = Window.partitionBy("c.part", "c.source").orderBy("key", "id", "mark", "size")
    sum_to = F.sum(words).over(inside.rowsBetween(Window.unboundedPreceding, 0))
    return ranges.alias("c").join(plan.alias("p"), _alike("c", "p", ["source", "part"])).select(
        "c.source", "id", "mark", "size", "copies", "source_size", "target",
        (F.col("offset") + sum_to - words).alias("before"),
    )


def numbered(rows: DataFrame, names) -> DataFrame:
    """`rows` with `number`, from 0, among those that agree in `names`. `rows` has a column `lot`, the task it was read
    by: rows are counted by lot first, so rows that agree need not meet in one task."""
    lots = staged(rows, "lots")
    earlier = Window.partitionBy(*names).orderBy("lot").rowsBetween(Window.unboundedPreceding, -1)
    offsets = lots.groupBy(*names, "lot").count().select(
        *names, "lot", F.coalesce(F.sum("count").over(earlier), F.lit(0)).alias("offset")
    )
    of_lot = Window.partitionBy(*[f"r.{n}" for n in names], "r.lot").orderBy("r.lot")
    return lots.alias("r").join(offsets.alias("o"), _alike("r", "o", [*names, "lot"])).select(
        "r.*", (F.col("offset") + F.row_number().over(of_lot) - 1).alias("number")
    )


def turns(rows: DataFrame) -> DataFrame:
    """A row per time that a row's turn can come, `copy` from 0, with `start`, the words of its source that are served
    before, repeats counted, and `finish`, its virtual finish time. Documents without words have no turn."""
    start = F.col("before") + F.col("copy") * F.col("source_size")
    copies = F.explode(F.sequence(F.lit(0).cast("long"), F.lit(COPIES - 1).cast("long")))
    return rows.filter("size > 0 and target > 0").withColumn("copy", copies).withColumn("start", start).withColumn(
        "finish", (F.col("start") + F.col("size")) / F.col("target")
    )


def in_order(own: DataFrame) -> DataFrame:
    """`own` (turns) in the order of finish times over all sources, with `served`: the words of all turns up to and with this one.

    The order is a range sort; its words are added up range by range, then inside each range."""
    place = ("finish", "source", "start")
    ranges = staged(own.repartitionByRange(*place).withColumn("part", F.spark_partition_id()), "finish")
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    # one row per range
    offsets = ranges.groupBy("part").agg(F.sum("size").alias("words")).select(
        "part", F.coalesce(F.sum("words").over(earlier), F.lit(0)).alias("offset")
    )
    sum_to = F.sum("size").over(Window.partitionBy("part").orderBy(*place).rowsBetween(Window.unboundedPreceding, 0))
    return ranges.join(offsets, "part").withColumn("served", F.col("offset") + sum_to).drop("part", "offset")


def cut(order: DataFrame, goal: DataFrame) -> DataFrame:
    """`order` with `taken`: the words that each turn gets until the budget, the whole words of all targets, is used up.

    When a turn ends at virtual time f, all sources together have been served f times their targets. Turns that end
    before this is more than the targets are taken whole. What they leave of the budget goes to the documents in service at
    the cut, the first of each source behind it; each gets what its source is short of.
    """
    budget, rate = (x or 0 for x in goal.agg(F.sum(F.floor("target")), F.sum("target")).first())
    order = order.withColumn("whole", F.col("finish") * F.lit(float(rate)) <= F.lit(float(rate)))
    used = order.filter("whole").agg(F.max("served")).first()[0] or 0
    # one row per source
    parts = order.filter("not whole").groupBy("source").agg(F.min(F.struct("finish", "start", "target")).alias("t"))
    parts = staged(parts.select("source", "t.start", (F.floor("t.target") - F.col("t.start")).cast("long").alias("part")), "cut")
    rest = parts.agg(F.sum("part")).first()[0] or 0
    if used + rest != budget:
        raise ValueError(f"{used} words before the cut and {rest} in service are not the budget of {budget}")
    taken = F.when(F.col("whole"), F.col("size")).otherwise(F.coalesce("part", F.lit(0)))
    served = order.alias("o").join(parts.alias("p"), _alike("o", "p", ["source", "start"]), "left")
    return served.select("o.*", taken.cast("long").alias("taken")).drop("whole")


def words_taken(copy=0) -> Column:
    """Words of a document's copy that are served before virtual time 1."""
    start = F.col("before") + copy * F.col("source_size")
    return F.greatest(F.least(F.floor("target") - start, F.col("size")), F.lit(0)).cast("long")


def mix_sizes(docs: DataFrame, id_col="doc_id", text_col="text", source_col="source") -> DataFrame:
    """One row per row of `docs`: id, size, source_size, target, taken (words, repeats counted).

    A null text has no words; a null source is a source of its own, the last. Rows that repeat an
    id are documents of their own, next to each other in the shuffled order; rows without an id are placed by their
    texts. Which of two rows with the same id, source and text comes first makes no difference. An empty table
    gives no rows.
    """
    sizes = staged(with_sizes(docs, {id_col: "id", source_col: "source"}, text_col), "sizes")
    goal = staged(targets(sizes), "goal")
    # rows that agree are made again from their number
    rows = numbered_copies(queue(sizes, goal), "copies", RUN)
    rows = rows.withColumn("before", F.col("before") + F.col("number") * F.col("size"))
    rows = rows.select("id", "source", "size", "source_size", "target", "before")
    served = cut(in_order(turns(rows)), goal)
    # the turns of a row are those of its place in its queue
    taken = served.groupBy("source", "before").agg(
        *[F.first(c).alias(c) for c in ("id", "size", "source_size", "target")], F.sum("taken").alias("taken")
    )
    columns = ["id", "size", "source_size", "target", "taken"]
    idle = rows.filter("not (size > 0 and target > 0)").withColumn("taken", F.lit(0).cast("long"))
    return taken.select(columns).unionByName(idle.select(columns)).withColumnRenamed("id", id_col)


def mix(docs: DataFrame, id_col="doc_id", text_col="text", source_col="source") -> DataFrame:
    """The mix itself: the columns of `docs`, a row per copy taken, in order of virtual finish time.

    A second copy is a row of its own. The truncated document of each source keeps its first words,
    with one space between them. Documents without words are in no mix. Of rows with the same id, source and text it is
    left open which are taken first. An empty table gives no rows.
    """
    names = {c: f"c{i}" for i, c in enumerate(docs.columns)}
    sizes = staged(with_sizes(docs, {id_col: "id", source_col: "source"}, text_col), "sizes")
    # documents that begin behind the target are in no mix
    classes = staged(queue(sizes, targets(sizes)).filter((F.col("size") > 0) & (F.col("before") < F.floor("target"))), "classes")
    packed = with_sizes(docs, names, text_col).withColumn("lot", F.spark_partition_id())
    packed = packed.withColumn("id", F.col(names[id_col])).withColumn("source", F.col(names[source_col]))
    agree = ["source", "id", "mark", "size"]
    rows = packed.alias("r").join(classes.alias("c"), _alike("r", "c", agree)).select(
        "r.*", "copies", "source_size", "target", "before"
    )
    if classes.filter("copies > 1").isEmpty():
        rows = rows.withColumn("number", F.lit(0).cast("long"))
    else:
        once = rows.filter("copies = 1").withColumn("number", F.lit(0).cast("long"))
        rows = once.unionByName(numbered(rows.filter("copies > 1"), agree))
    rows = rows.withColumn("before", F.col("before") + F.col("number") * F.col("size"))
    copies = F.array(*[
        F.struct(
            F.lit(c).alias("copy"), words_taken(c).alias("taken"),
            ((F.col("before") + c * F.col("source_size") + F.col("size")) / F.col("target")).alias("finish"),
        )
        for c in range(COPIES)
    ])
    rows = rows.withColumn("part", F.explode(F.filter(copies, lambda c: c["taken"] > 0)))
    text = F.col(names[text_col])
    words = F.filter(F.split(text, "[\\x20\\x09-\\x0D]+"), lambda x: x != "")
    first_words = F.array_join(F.slice(words, 1, F.col("part.taken").cast("int")), " ")
    cut = F.when(F.col("part.taken") < F.col("size"), first_words).otherwise(text)
    rows = rows.withColumn(names[text_col], cut).orderBy("part.finish", "id", "part.copy")
    return rows.select(*[F.col(name).alias(c) for c, name in names.items()])
