"""Registered queries of the subpackage: thin uses of the operators on the tables of a folder."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import decontaminate as decon
from caselode.session import own_folder, staged

from . import hard_negatives, jaccard_join, license_scan, line_dedup, merkle, mixing, pii, secrets, token_output, warc
from . import quality_classifier as classifier
from . import quality_rules as rules
from .common import table
from .sql import ORACLE_SQL  # noqa: F401


def tokenizer_file() -> str:
    """The vocabulary file of the installed public tokenizers."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def op1_quality_classifier(spark: SparkSession, folder: str) -> DataFrame:
    return classifier.score_quality(table(spark, folder, "documents"), table(spark, folder, "labels"))


def op2_jaccard_join(spark: SparkSession, folder: str) -> DataFrame:
    return jaccard_join.jaccard_join(table(spark, folder, "documents"))


def op3_decontaminate(spark: SparkSession, folder: str) -> DataFrame:
    found = decon.scan_benchmark(table(spark, folder, "documents"), table(spark, folder, "benchmark"))
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"), "contaminated",
    )


def op4_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    judged = rules.quality_rules(table(spark, folder, "documents"))
    return judged.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "base_failed", "kept", "posterior",
    )


def op5_mixing(spark: SparkSession, folder: str) -> DataFrame:
    return mixing.mix_sizes(table(spark, folder, "documents"))


def op6_token_output(spark: SparkSession, folder: str) -> DataFrame:
    path = own_folder(spark, "tokens")
    token_output.write_tokens(table(spark, folder, "documents"), path, tokenizer_file())
    return token_output.token_digests(spark, path)


def op7_license_scan(spark: SparkSession, folder: str) -> DataFrame:
    scanned = license_scan.license_scan(table(spark, folder, "documents"))
    return scanned.select(
        "doc_id", "n_sentences", F.size("found").cast("long").alias("n_found"), license_scan.licenses().alias("licenses"),
        F.round(F.array_max(F.transform("found", lambda x: x["saved"])), 4).alias("best_saved"),
        F.coalesce(F.aggregate("found", F.lit(0).cast("long"), lambda n, x: n + F.size(x["differing"])), F.lit(0))
        .alias("n_differing"),
    )


def _span_digests(found: DataFrame, base_kinds, all_kinds) -> DataFrame:
    """Counts of the base spans, the hash of them and all spans, written as kind:start:end in order."""
    rank = F.create_map(*[F.lit(x) for i, k in enumerate(all_kinds) for x in (k, i)])
    written = lambda spans: F.array_join(F.transform(
        F.array_sort(F.transform(spans, lambda s: F.struct(s["start"], rank[s["kind"]], s["end"], s["kind"]))),
        lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string")),
    ), ",")
    count = lambda kind: F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    return found.select(
        "doc_id", *map(count, base_kinds), F.sha2(written(F.col("base")), 256).alias("base_sha256"),
        written(F.concat("base", "added")).alias("spans"),
    )


def op8_pii(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    return _span_digests(pii.find_pii(docs, pii.trained_field(docs)), pii.KINDS, pii.KINDS)


def op9_warc(spark: SparkSession, folder: str) -> DataFrame:
    pages = table(spark, folder, "pages")
    path = own_folder(spark, "warc")
    warc.write_archives(pages, path)
    found = staged(warc.captures(warc.read_records(spark, path, with_payload=False)), "captures")
    rows = warc.with_referred_pages(found)
    kind = pages.schema["page_id"].dataType
    return rows.select(
        F.col("page").cast(kind).alias("page_id"), "response.payload_bytes", "response.payload_digest",
        F.col("response.kind").alias("record_type"), F.col("refers_to").cast(kind).alias("refers_to"),
    )


def op10_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    cleaned = line_dedup.line_dedup(table(spark, folder, "documents"))
    return cleaned.select("doc_id", "n_lines", "n_removed", F.sha2("text", 256).alias("text_sha256"))


def op11_secret_scan(spark: SparkSession, folder: str) -> DataFrame:
    found = secrets.find_secrets(table(spark, folder, "documents"))
    return _span_digests(found, secrets.KINDS, (*secrets.KINDS, secrets.ADDED))


def op12_hard_negatives(spark: SparkSession, folder: str) -> DataFrame:
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.mine(table(spark, folder, "embeddings"), F.col("vec_id") % 100 == 0, label=label)


def op13_merkle_manifest(spark: SparkSession, folder: str) -> DataFrame:
    number = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    manifest = merkle.build(
        table(spark, folder, "documents"), changed={"text": merkle.lowered(F.col("text"))}, when=number % 5 == 0
    )
    return merkle.proofs(manifest).withColumnRenamed("id", "doc_id").drop("grp")


QUERIES = {
    "op1_quality_classifier": op1_quality_classifier,
    "op2_jaccard_join": op2_jaccard_join,
    "op3_decontaminate": op3_decontaminate,
    "op4_quality_rules": op4_quality_rules,
    "op5_mixing": op5_mixing,
    "op6_token_output": op6_token_output,
    "op7_license_scan": op7_license_scan,
    "op8_pii": op8_pii,
    "op9_warc": op9_warc,
    "op10_line_dedup": op10_line_dedup,
    "op11_secret_scan": op11_secret_scan,
    "op12_hard_negatives": op12_hard_negatives,
    "op13_merkle_manifest": op13_merkle_manifest,
}
