"""Fixed values of the court profile: word lists, patterns, limits and labels.

Everything in this file is data.  The patterns are written for Java's regular
expressions; ``(?U)`` makes ``\\s`` and ``\\d`` Unicode-aware, ``(?d)`` lets ``.``
stop at ``\\n`` only.  Repeated groups are possessive where nothing follows them,
which matches the same text and keeps the matcher off the call stack.
"""

# --- Fixed values: white space and line breaks ------------------------------
# ``\s`` under (?U) lacks the four separators U+001C..U+001F.
SPACE = r"[\s\x1c-\x1f]"
SPACES = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)
LINE_BREAK = r"[\n\r\x0b\x0c\x1c-\x1e\x85\x{2028}\x{2029}]"

# --- Fixed values: literal boilerplate, removed in this order ---------------
BOILERPLATE_LITERALS = (
    "M a h ka m a h A g u n g R e p u blik In d o n esia",
    "Disclaimer",
    "Direktori Putusan Republik Indonesia",
    "direktori putusan republik indonesia",
    "putusan. .go.id",
    "Putusan. .go.id",
    "Kepaniteraan Mahkamah Agung Republik Indonesia berusaha untuk selalu "
    "mencantumkan informasi paling kini dan akurat sebagai bentuk komitmen "
    "Mahkamah Agung untuk pelayanan publik, transparansi dan akuntabilitas",
    "pelaksanaan fungsi peradilan. Namun dalam hal-hal tertentu masih "
    "dimungkinkan terjadi permasalahan teknis terkait dengan akurasi dan "
    "keterkinian informasi yang kami sajikan, hal mana akan terus kami "
    "perbaiki dari waktu kewaktu.",
    "Dalam hal Anda menemukan inakurasi informasi yang termuat pada situs "
    "ini atau informasi yang seharusnya ada, namun belum tersedia, maka "
    "harap segera hubungi Kepaniteraan Mahkamah Agung RI melalui :",
    "Email : kepaniteraan@mahkamahagung.go.id    Telp : 021-384 3348 (ext.318)",
)

# --- Fixed values: boilerplate patterns, each replaced by one blank, in order
BOILERPLATE_PATTERNS = (
    r"(?:republik{s}+indonesia{s}*\n?){{2,}}+",
    r"direktori{s}+putusan[^\n]*\n?",
    r"putusan{s}*\.{s}*\.?{s}*go{s}*\.?{s}*id[^\n]*\n?",
    r"M{s}+a{s}+h{s}+k?{s}*a{s}+m{s}+a{s}+h{s}+A{s}+g{s}+u{s}+n{s}+g",
    r"halaman{s}*\d+{s}*(?:dari{s}*\d+{s}*halaman)?",
    r"(?<!\d)\d++{s}*hal\.{s}*put\.{s}*nomor[^\n]*",
    r"disclaimer",
)

# --- Fixed values: content lines and tokens ----------------------------------
BOILERPLATE_MARKERS = (
    "direktori", "putusan.go.id", "putusan..go.id",
    "kepaniteraan", "disclaimer", "inakurasi",
)
HEADLINE = r"(?U)\A[\s\x1c-\x1f]*+(?:republik[\s\x1c-\x1f]+indonesia[\s\x1c-\x1f]*+)++\z"
# all but line ends, printable ASCII and U+00C0..U+00FF; a negated class is ten times slower
DROPPED_CHARACTERS = r"[\x00-\x09\x0b-\x1f\x7f-\xbf\x{100}-\x{10ffff}]++"
WORD_TOKEN = r"[a-zA-Z0-9]++(?:[-'][a-zA-Z0-9]++)*+"
TERM_TOKEN = r"[\p{L}\p{N}_]{2,}"

# --- Fixed values: validity limits ---------------------------------------------
MIN_WORDS = 100
MIN_COMPLETENESS = 0.5
MIN_RAW_WORDS = 50
TARGET_VALID = 90
REQUIRED_VALID = 30
MAX_MISSING_RATE = 0.10
LINK_TARGET = 1000

# --- Fixed values: page fields (column, label to look for) -----------------------
PAGE_FIELDS = (
    ("no_perkara", "Nomor"),
    ("tanggal_register", "Tanggal Register"),
    ("tanggal_musyawarah", "Tanggal Musyawarah"),
    ("klasifikasi", "Klasifikasi"),
    ("kata_kunci", "Kata Kunci"),
    ("lembaga_peradilan", "Lembaga Peradilan"),
    ("hakim_ketua", "Hakim Ketua"),
    ("panitera", "Panitera"),
    ("amar", "Amar"),
    ("amar_lainnya", "Amar Lainnya"),
    ("catatan_amar", "Catatan Amar"),
)
DETAIL_LINK = r"/direktori/putusan/"
DETAIL_SLUG = r"/direktori/putusan/([a-zA-Z0-9\-]+)\.html"
DOCUMENT_LINK = r"/pdf/"
CASE_KIND = "Perdata - Perbuatan Melawan Hukum (PMH)"
RETIRED_KIND = "Senjata Api"
COURT = "PN Bandung"

# --- Fixed values: quality columns and reason codes, in report order -----------------
CHECKED_COLUMNS = (
    "no_perkara", "tanggal_register", "klasifikasi",
    "amar", "hakim_ketua", "judul",
)
FLAG_REASONS = (
    "file_raw_hilang",
    "file_token_hilang",
    "dokumen_kosong",
    "keutuhan_di_bawah_80persen",
    "nomor_perkara_duplikat",
)

# --- Fixed values: parties ------------------------------------------------------------
PLAINTIFF, PLAINTIFF_ALIAS = "penggugat", "pemohon"
DEFENDANT, DEFENDANT_ALIAS = "tergugat", "termohon"
NAME_CHARACTER = r"[A-Za-z0-9\s.,\-/]"
# everything but name characters, for normalised text
NAME_GAP = r"[\x21-\x2b\x3a-\x40\x5b-\x60\x7b-\x{10ffff}]+"
REPRESENTED = "dalam hal ini diwakili"
NAMED_HEREAFTER = r"selanjutnya\s+disebut\s+(?:sebagai\s+)?{party}"
NAMED_AS = r"(?:dalam hal ini diwakili\s+oleh\s+.+?)?\s*sebagai\s+{party}"
NAMED_AFTER = r"{party}\s*(?:adalah|:)?\s*([A-Z][A-Za-z0-9\s.,\-/]{{3,60}})"
NAMED_FALLBACK = r"(?:{party}|{alias})\s*[:\-]?\s*([A-Z][A-Za-z\s.]{{3,50}})"
NOT_DETECTED = "tidak terdeteksi"
MAX_PARTIES = 5

# --- Fixed values: statutes ---------------------------------------------------------------
STATUTE_PATTERNS = (
    r"pasal\s+\d+(?:\s+ayat\s+\(\d+\))?\s+(?:jo\.?\s+pasal\s+\d+\s+)?[A-Za-z.]+(?:\s+\d{4})?",
    r"pasal\s+\d+(?:\s*[,/]\s*\d+)*+\s+[A-Za-z.]+",
    r"pasal\s+\d+\s+huruf\s+[a-z]\s+[A-Za-z.]+",
)
MAX_STATUTES = 10

# --- Fixed values: sections -----------------------------------------------------------------
FACT_SECTIONS = (
    r"duduk\s+perkara\s*\n+((?:.+\n?){1,15})",
    r"posita\s*\n+((?:.+\n?){1,15})",
    r"tentang\s+duduk\s+perkara\s*\n+((?:.+\n?){1,15})",
    r"kronologi\s*\n+((?:.+\n?){1,10})",
)
FACT_OPENING = r"menimbang\s*[:,]?\s*"
FACT_CLAUSE = r"menimbang\s*[:,]?\s*(.*?)(?=menimbang|mengadili|memutus)"
ARGUMENT_SECTIONS = (
    r"pertimbangan\s+hukum\s*\n+((?:.+\n?){1,20})",
    r"pertimbangan\s+majelis\s*\n+((?:.+\n?){1,20})",
)
ARGUMENT_CLAUSE = r"menimbang\s*,?\s*bahwa\s+(.+?)(?=menimbang|mengadili|;|\n\n)"
MIN_FACT_WORDS, MIN_ARGUMENT_WORDS = 30, 20
SECTION_CHARS, PREVIEW_CHARS, SAMPLE_CHARS, QUERY_CHARS = 800, 5000, 300, 500

# --- Fixed values: outcome rules, first hit wins; the fourth can never be reached -------------
DECISION_RULES = (
    ("dikabulkan_seluruhnya", ("dikabulkan untuk seluruhnya", "dikabulkan seluruhnya")),
    ("dikabulkan_sebagian", ("dikabulkan untuk sebagian", "dikabulkan sebagian")),
    ("ditolak", ("ditolak", "tidak dapat diterima")),
    ("niet_ontvankelijke_verklaard", ("gugatan tidak dapat diterima",)),
    ("gugur", ("gugur",)),
    ("dikabulkan", ("dikabulkan",)),
)
OTHER = "lainnya"
GRANTED, REJECTED = "dikabulkan", "ditolak"
REJECTED_LABELS = ("ditolak", "tidak dapat diterima", "niet_ontvankelijke_verklaard")

# --- Fixed values: model settings -----------------------------------------------------------------
MIN_DF, MAX_FEATURES = 2, 10_000
TEST_SHARE, SEED, TOP_K, N_QUERIES = 0.2, 42, 5, 10
NB_ALPHA, SVM_C = 0.1, 1.0

# Width of a bucket of a random projection of unit vectors, and tables of such buckets.
LSH_BUCKET, LSH_TABLES = 1.0, 12
