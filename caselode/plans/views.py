"""Court-like input tables derived from the given tables, row by row.

The given tables hold invented prose.  ``CASE_VIEW`` wraps every document as a
decision, ``DETAIL_VIEW`` wraps every page as a case page, so that the court
patterns match at every scale.  Both strings are plain SQL over whole tables.
"""

from pyspark.sql import DataFrame, SparkSession, functions as F

from caselode.functions import extract
from caselode.functions.extract import decision, merged_label
from caselode.functions.text import strip
from caselode.operators import corpus, features, represent
from caselode.session import staged
from caselode.sources.readers import spread, table

CASE_VIEW = """
SELECT d.doc_id,
 'case_' || md5(CAST(d.doc_id AS STRING)) AS case_id,
 CASE WHEN d.doc_id % 11 = 0 THEN ''
      ELSE CAST(d.doc_id % 150 + 1 AS STRING) || '/Pdt.G/2025/PN Xyz' END AS no_perkara,
 CASE WHEN d.doc_id % 13 = 0 THEN '' WHEN l.quality IS NULL THEN 'Lain-lain'
      WHEN l.quality = 1 AND l.toxic = 0 THEN 'Dikabulkan untuk seluruhnya'
      WHEN l.quality = 1 THEN 'Dikabulkan sebagian'
      WHEN l.toxic = 0 THEN 'Ditolak' ELSE 'Gugur' END AS amar,
 CASE WHEN d.doc_id % 6 = 0 THEN '' ELSE '1 Januari 2025' END AS tanggal_register,
 d.lang AS klasifikasi,
 CASE WHEN d.doc_id % 17 = 0 THEN NULL ELSE 'Hakim ' || d.source END AS hakim_ketua,
 'Putusan ' || d.source AS judul,
 CASE WHEN d.doc_id % 19 = 0 THEN 'Pidana Khusus - SENJATA API'
      ELSE 'Perdata - Perbuatan Melawan Hukum (PMH)' END AS jenis_perkara,
 'PN Xyz' AS pengadilan,
 CASE WHEN d.doc_id % 23 = 0 THEN '' ELSE '/pdf/' || CAST(d.doc_id AS STRING) END AS url_pdf,
 'Direktori Putusan Republik Indonesia' || chr(10) || 'Republik Indonesia' || chr(10)
 || 'Republik Indonesia' || chr(10)
 || 'Halaman ' || CAST(d.doc_id % 7 + 1 AS STRING) || ' dari 9 halaman' || chr(10)
 || 'antara : Pihak ' || d.source || ', selanjutnya disebut sebagai penggugat; melawan : Badan '
 || d.lang || ', selanjutnya disebut tergugat;' || chr(10)
 || CASE WHEN d.doc_id % 3 = 0 THEN 'duduk perkara' || chr(10) ELSE '' END
 || CASE WHEN d.doc_id % 29 = 7 THEN '3 hal. put. nomor 7 ' || replace(d.text, chr(10), ' ') ELSE d.text END || chr(10)
 || 'menimbang, bahwa pasal ' || CAST(1300 + d.doc_id % 90 AS STRING)
 || ' KUHPerdata dan pasal 1365 KUHPerdata berlaku;;' || chr(10)
 || CASE WHEN d.doc_id % 5 = 0 THEN 'gugatan ditolak' ELSE 'mengadili' END || chr(10) AS raw_text
FROM {documents} d LEFT JOIN {labels} l ON d.doc_id = l.doc_id
"""

DETAIL_VIEW = """
SELECT page_id,
 CASE WHEN page_id % 7 = 0 THEN 'https://court.example/berkas/' || CAST(page_id AS STRING)
      ELSE 'https://court.example/direktori/putusan/' || md5(url) || '-'
           || md5(CAST(page_id AS STRING)) || '.html' END AS url,
 CASE WHEN page_id % 9 = 0 THEN '<html><body>' ELSE
 '<html><body><table class="table table-case"><tr><td colspan="2"><h2> Putusan Nomor '
 || CAST(page_id AS STRING) || ' </h2></td></tr>'
 || '<tr><td>Nomor</td><td> <b>' || CAST(page_id AS STRING) || '</b>/Pdt.G/2025/PN Xyz </td></tr>'
 || '<tr><td>Tanggal Register</td><td>' || CAST(page_id % 28 + 1 AS STRING) || ' Mei 2025</td></tr>'
 || '<tr><td>Tanggal Musyawarah</td><td>' || CAST(page_id % 28 + 1 AS STRING) || ' Juni 2025</td></tr>'
 || '<tr><td>Klasifikasi</td><td>' || url || '</td></tr>'
 || CASE WHEN page_id % 5 = 0 THEN ''
         WHEN page_id % 8 = 3 THEN '<tr><td>Kata Kunci</td><td><table class="inner"><tr><td>ganti&nbsp;rugi &eacute;&#233;&#xE9;</td>'
              || '<td>&hellip; <i>Amar</i></td></tr></table></td></tr>' ELSE '<tr><td>Kata Kunci</td><td>ganti rugi &amp; biaya</td></tr>' END
 || '<tr><td>Lembaga Peradilan</td><td>PN Xyz</td></tr>'
 || '<tr><td>Hakim Ketua</td><td>Hakim ' || CAST(page_id % 20 AS STRING) || '</td></tr>'
 || '<tr><td>Panitera</td><td></td></tr>'
 || '<tr><td>Amar Lainnya</td><td>verstek</td></tr>'
 || '<tr><td>Amar</td><td>ditolak</td></tr>'
 || '<tr><td>Catatan Amar</td><td>catatan ' || CAST(page_id AS STRING) || '</td></tr></table>' END
 || CASE WHEN page_id % 4 = 0 THEN ''
         ELSE '<a class="x" href="/direktori/pdf/' || CAST(page_id AS STRING) || '">unduh</a>' END
 || html || '</body></html>' AS html
FROM {pages}
"""

# The raw text leaves the table once it is measured.
_META = (
    "case_id", "no_perkara", "tanggal_register", "klasifikasi", "amar", "hakim_ketua",
    "judul", "jenis_perkara", "pengadilan", "url_pdf", "raw_words", "jumlah_kata",
    "keutuhan_teks", "valid_min_200_kata", "status",
)


def documents(spark: SparkSession, folder: str) -> DataFrame:
    return spread(table(spark, folder, "documents"), "doc_id")


def case_texts(spark: SparkSession, folder: str) -> DataFrame:
    """Raw decisions, one per document."""
    return spark.sql(
        CASE_VIEW, documents=documents(spark, folder), labels=table(spark, folder, "labels")
    )


def detail_pages(spark: SparkSession, folder: str) -> DataFrame:
    return spark.sql(DETAIL_VIEW, pages=spread(table(spark, folder, "pages"), "page_id"))


def measured(spark: SparkSession, folder: str) -> DataFrame:
    return corpus.measured(case_texts(spark, folder))


def metadata(spark: SparkSession, folder: str) -> DataFrame:
    """Measures of every case without its text."""
    return measured(spark, folder).select("doc_id", *_META)


def valid_texts(spark: SparkSession, folder: str) -> DataFrame:
    """Normalised text of the valid cases; the others are dropped before that work."""
    valid = measured(spark, folder).filter("valid_min_200_kata").drop("raw_text")
    return corpus.normalised(valid).drop("cleaned")


def staged_metadata(spark: SparkSession, folder: str) -> DataFrame:
    return staged(metadata(spark, folder), "metadata")


def inventories(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    """Ids that have a text, a token list, an archive: taken from three other tables."""

    def ids(name, column):
        key = F.md5(F.col(column).cast("string"))
        return table(spark, folder, name).select(F.concat(F.lit("case_"), key).alias("case_id"))

    return {
        "raw": ids("labels", "doc_id"),
        "tokens": ids("conversations", "conv_id"),
        "archive": ids("embeddings", "vec_id"),
    }


def cases(spark: SparkSession, folder: str) -> DataFrame:
    """Case records of all valid decisions.

    Text and metadata come from the same row here; ``represent.valid_with_text``
    joins them where they are stored apart.
    """
    return represent.case_records(valid_texts(spark, folder).filter(F.col("normalised") != ""))


def case_features(spark: SparkSession, folder: str) -> DataFrame:
    """Feature text and label per case, written once: later stages read it many times."""
    return staged(features.case_features(cases(spark, folder)), "features")


def solved_documents(spark: SparkSession, folder: str) -> DataFrame:
    """Documents with their disposition, the facts of valid cases without one, and their label.

    Facts are taken from the texts of those rows only that have no disposition to reuse.
    """
    labelled = labelled_documents(spark, folder)
    bare = F.coalesce(F.trim("amar"), F.lit("")) == ""
    texts = corpus.measured(case_texts(spark, folder).filter(bare)).filter("valid_min_200_kata").drop("raw_text")
    texts = corpus.normalised(texts).filter("normalised != ''")
    facts = texts.select("doc_id", extract.facts(F.col("normalised")).alias("ringkasan_fakta"))
    return labelled.join(facts, "doc_id", "left")


def labelled_documents(spark: SparkSession, folder: str) -> DataFrame:
    """Whole document texts with disposition and merged label."""
    text = F.coalesce("amar", F.lit(""))
    return case_texts(spark, folder).select(
        "doc_id", "case_id", "amar",
        merged_label(decision(text, F.lit(""))).alias("label"),
    )


def benchmark(spark: SparkSession, folder: str) -> DataFrame:
    """Query texts; an asked text is lowered and stripped."""
    return table(spark, folder, "benchmark").select(
        F.col("item_id").alias("query_id"), strip(F.lower("text")).alias("query_text")
    )
