"""Case records: fields and label extracted from each valid text (REP-1 .. REP-11)."""

from pyspark.sql import DataFrame, functions as F

from caselode import profile as P
from caselode.functions import extract as X
from caselode.functions.text import words


def valid_with_text(meta: DataFrame, texts: DataFrame, text: str = "normalised") -> DataFrame:
    """Valid metadata rows with their text; rows without text are dropped (REP-1)."""
    return (
        meta.filter("valid_min_200_kata")
        .join(texts.select("case_id", text), "case_id")
        .filter(F.col(text) != "")
    )


def extracted(df: DataFrame, text: str = "normalised", disposition: str = "amar") -> DataFrame:
    """Add the extracted fields; narrow, and fields that nobody reads are not computed."""
    t = F.col(text)
    return df.withColumns(
        {
            "_plaintiff": X.parties(t, P.PLAINTIFF, P.PLAINTIFF_ALIAS),
            "_defendant": X.parties(t, P.DEFENDANT, P.DEFENDANT_ALIAS),
            "ringkasan_fakta": X.facts(t),
            "argumen_hukum": X.arguments(t),
            "pasal": X.statutes(t),
            "amar_putusan": F.coalesce(disposition, F.lit("")),
            "decision_type": X.decision(F.col(disposition), t),
        }
    )


def case_records(
    df: DataFrame, text: str = "normalised", folder: str = "data/raw"
) -> DataFrame:
    """The 23 columns of a case record (REP-8, REP-9, REP-10)."""
    df = extracted(df, text)
    return df.select(
        "case_id",
        "no_perkara",
        F.col("tanggal_register").alias("tanggal"),
        "jenis_perkara",
        "pengadilan",
        "hakim_ketua",
        "klasifikasi",
        F.col("_plaintiff.names").alias("penggugat"),
        F.col("_defendant.names").alias("tergugat"),
        F.col("_plaintiff.n").alias("num_penggugat"),
        F.col("_defendant.n").alias("num_tergugat"),
        "ringkasan_fakta",
        "argumen_hukum",
        "pasal",
        "amar_putusan",
        "decision_type",
        "jumlah_kata",
        "jumlah_token",
        words(F.col("ringkasan_fakta")).alias("panjang_ringkasan_fakta"),
        words(F.col("argumen_hukum")).alias("panjang_argumen_hukum"),
        X.listed(F.col("pasal")).alias("jumlah_pasal_dirujuk"),
        X.preview(F.col(text)).alias("text_full"),
        F.concat(F.lit(f"{folder}/"), "case_id", F.lit(".txt")).alias("raw_file_path"),
    )


def label_distribution(cases: DataFrame) -> DataFrame:
    return cases.groupBy("decision_type").agg(F.count("*").alias("n_cases"))


def coverage(cases: DataFrame) -> DataFrame:
    """Cases in which a party's name was found (REP-11)."""
    return cases.agg(
        F.count("*").alias("n_cases"),
        F.count_if(F.col("penggugat") != P.NOT_DETECTED).alias("n_penggugat"),
        F.count_if(F.col("tergugat") != P.NOT_DETECTED).alias("n_tergugat"),
    )
