"""Fixed schemas of the tables that stages exchange."""

_FIELDS = (
    "no_perkara string, tanggal_register string, tanggal_musyawarah string, "
    "klasifikasi string, kata_kunci string, lembaga_peradilan string, hakim_ketua string, "
    "panitera string, amar string, amar_lainnya string, catatan_amar string"
)
METADATA = (
    "case_id string, judul string, jenis_perkara string, pengadilan string, url_detail string, "
    "url_pdf string, jumlah_kata int, jumlah_token int, keutuhan_teks double, "
    f"valid_min_200_kata boolean, {_FIELDS}"
)
CASES = (
    "case_id string, no_perkara string, tanggal string, jenis_perkara string, "
    "pengadilan string, hakim_ketua string, klasifikasi string, penggugat string, "
    "tergugat string, num_penggugat int, num_tergugat int, ringkasan_fakta string, "
    "argumen_hukum string, pasal string, amar_putusan string, decision_type string, "
    "jumlah_kata int, jumlah_token int, panjang_ringkasan_fakta int, "
    "panjang_argumen_hukum int, jumlah_pasal_dirujuk int, text_full string, "
    "raw_file_path string"
)
QUERIES = (
    "query_id string, case_id string, no_perkara string, decision_type string, "
    "query_text string, ground_truth_case_id string, expected_similar_case_ids array<string>, "
    "top5_tfidf array<string>, top5_bert array<string>"
)
PREDICTIONS = "query_id string, predicted_solution string, top_5_case_ids string"
EMBEDDINGS = "case_id string, embedding array<float>"
TOKENS = "case_id string, tokens array<string>"
