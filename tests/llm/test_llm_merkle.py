"""The Merkle manifest against a plain in-memory one, and what its defined cases give."""

import hashlib
import zlib

import pytest
from pyspark.sql import functions as F

from caselode.llm import merkle


def _hash(text):
    return hashlib.sha256(text.encode()).hexdigest()


def _leaf(row, text):
    fields = (row.doc_id, row.source, row.lang, row.n_chars, text)
    return _hash("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in fields))


def _levels(digests):
    levels = [digests]
    while len(levels[-1]) > 1:
        below = levels[-1]
        levels.append([_hash("".join(below[i : i + 16])) for i in range(0, len(below), 16)])
    return levels


def _lowered(text):
    return text if text is None else "".join(c.lower() if "A" <= c <= "Z" else c for c in text)


def expected(rows):
    groups = {}
    for r in rows:
        groups.setdefault(r.source, []).append(r)
    for members in groups.values():
        members.sort(key=lambda r: (r.doc_id is not None, r.doc_id or 0, _leaf(r, r.text)))
    order = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    trees = [_levels([_leaf(r, r.text) for r in groups[g]]) for g in order]
    top = _levels([t[-1][0] for t in trees])
    root, out = top[-1][0], []
    for k, g in enumerate(order):
        for i, r in enumerate(groups[g]):
            tampered = r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 5 == 0
            own, proof = _leaf(r, _lowered(r.text) if tampered else r.text), []
            for levels, at in ((trees[k], i), (top, k)):
                for below in levels[:-1]:
                    first = at // 16 * 16
                    run = below[first : first + 16]
                    left, right = run[: at - first], run[at - first + 1 :]
                    proof += left + right
                    own, at = _hash("".join([*left, own, *right])), at // 16
            out.append((r.doc_id, _leaf(r, r.text), trees[k][-1][0], root, _hash("".join(proof)), own, own == root))
    return out


def _tampered(docs):
    number = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    return merkle.build(docs, changed={"text": merkle.lowered(F.col("text"))}, when=number % 5 == 0)


def _proved(manifest):
    columns = ("id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")
    return [tuple(r) for r in merkle.proofs(manifest).select(*columns).collect()]


def _sorted(rows):
    return sorted(rows, key=lambda r: tuple(map(str, r)))


def test_edge_rows_equal_brute_force(edge_docs):
    assert _sorted(_proved(_tampered(edge_docs))) == _sorted(expected(edge_docs.collect()))


@pytest.mark.parametrize("n", [1, 17, 257, 4097])
def test_trees_of_every_height(spark, n):
    """One group with most rows, one with a few, a lone leaf and rows without a group; ids in no order."""
    docs = spark.range(n).select(
        ((F.col("id") * 7919) % 100_003).alias("doc_id"), F.concat(F.lit("Text "), F.col("id").cast("string")).alias("text"),
        F.lit(None).cast("string").alias("lang"), F.when(F.col("id") % 50 == 1, "b").when(F.col("id") == 2, "é")
        .when(F.col("id") % 50 == 3, None).otherwise("a").alias("source"), F.col("id").alias("n_chars"),
    )
    assert _sorted(_proved(_tampered(docs))) == _sorted(expected(docs.collect()))


def test_many_groups(spark):
    docs = spark.range(600).select(
        F.col("id").alias("doc_id"), F.lit("x").alias("text"), F.lit("en").alias("lang"),
        F.concat(F.lit("s"), F.col("id").cast("string")).alias("source"), F.lit(1).alias("n_chars"),
    )
    assert _sorted(_proved(_tampered(docs))) == _sorted(expected(docs.collect()))


def test_a_proof_names_the_runs_up_to_the_root(spark):
    docs = spark.createDataFrame([(i, "s", "en", 1, f"t{i}") for i in range(20)], "doc_id int, source string, lang string, n_chars int, text string")
    manifest = merkle.build(docs)
    for row in merkle.proofs(manifest, with_siblings=True).collect():
        assert row.verified and row.folded_root == manifest.root
        own = row.leaf
        for step in row.proof:
            assert step.run[step.place] == own
            own = _hash("".join(step.run))
        assert own == manifest.root


def test_a_changed_row_is_found_whatever_changed(spark):
    docs = spark.createDataFrame([(i, "s", "en", i, "Same") for i in range(40)], "doc_id int, source string, lang string, n_chars int, text string")
    manifest = merkle.build(docs, changed={"n_chars": F.lit(None)}, when=F.col("doc_id") == 7)
    assert [r.id for r in merkle.proofs(manifest).filter("not verified").collect()] == [7]


def test_empty_table_has_no_root(no_docs):
    manifest = merkle.build(no_docs)
    assert manifest.root is None and merkle.proofs(manifest).count() == 0


def test_saved_manifest_gives_the_same_proofs(spark, edge_docs, tmp_path):
    manifest = _tampered(edge_docs)
    merkle.save(manifest, f"{tmp_path}/manifest")
    stored = merkle.load(spark, f"{tmp_path}/manifest")
    assert stored.root == manifest.root and _sorted(_proved(stored)) == _sorted(_proved(manifest))
    with pytest.raises(FileNotFoundError):
        merkle.load(spark, f"{tmp_path}/nothing")


def test_rows_do_not_depend_on_the_number_of_tasks(spark, edge_docs):
    key = "spark.sql.shuffle.partitions"
    before, first = spark.conf.get(key), _proved(_tampered(edge_docs))
    spark.conf.set(key, "13")
    try:
        assert _sorted(_proved(_tampered(edge_docs.repartition(1)))) == _sorted(first)
    finally:
        spark.conf.set(key, before)
