"""One SQL statement per registered query, for an in-process DuckDB.

The statements are written from the operators' semantics with other means than
the Spark code: lists for line and token work, plain joins for similarities.
RE2 has neither look-around nor back-references, so sections are cut with marks.
"""

import re

from caselode import profile as P
from caselode.plans.views import CASE_VIEW, DETAIL_VIEW

_WS = r"\t-\r\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
_BREAK = r"[\n\r\x0b\x0c\x1c-\x1e\x{85}\x{2028}\x{2029}]"


def _lit(text):
    return "'" + text.replace("'", "''") + "'"


def _words(e):
    return f"CAST(len(regexp_extract_all({e}, '[^{_WS}]+')) AS INTEGER)"


def _strip(e):
    return f"regexp_replace({e}, '^[{_WS}]+|[{_WS}]+$', '', 'g')"


def _rep(e, pattern, to):
    return f"regexp_replace({e}, {_lit(pattern)}, {_lit(to)}, 'g')"


def _clean(e):
    for literal in P.BOILERPLATE_LITERALS:
        e = f"replace({e}, {_lit(literal)}, ' ')"
    s = f"[{_WS}]"
    for rule in (
        rf"(republik{s}+indonesia{s}*\n?){{2,}}",
        rf"direktori{s}+putusan[^\n]*\n?",
        rf"putusan{s}*\.{s}*\.?{s}*go{s}*\.?{s}*id[^\n]*\n?",
        rf"M{s}+a{s}+h{s}+k?{s}*a{s}+m{s}+a{s}+h{s}+A{s}+g{s}+u{s}+n{s}+g",
        rf"halaman{s}*\p{{Nd}}+{s}*(dari{s}*\p{{Nd}}+{s}*halaman)?",
        rf"\p{{Nd}}+{s}*hal\.{s}*put\.{s}*nomor[^\n]*",
        "disclaimer",
    ):
        e = _rep(e, "(?i)" + rule, " ")
    return _strip(_rep(_rep(e, "[ \\t]+", " "), "\\n{3,}", "\n\n"))


def _normalise(e):
    e = _rep(f"lower({e})", r"[^\x20-\x7e\x{c0}-\x{ff}\n]", " ")
    for ch in ".,;:":
        e = _rep(e, f"[{ch}]{{2,}}", ch)
    e = _rep(_rep(_rep(e, "[ \\t]+", " "), "\\n{3,}", "\n\n"), " *\\n *", "\n")
    return _strip(e)


def _tokens(e):
    return f"regexp_extract_all(lower({e}), '[a-zA-Z0-9]+(?:[-''][a-zA-Z0-9]+)*')"


def _content_words(e):
    s = f"[{_WS}]"
    keep = " AND ".join(f"NOT contains(lower(l), {_lit(m)})" for m in P.BOILERPLATE_MARKERS)
    keep += f" AND NOT regexp_full_match({_strip('lower(l)')}, '(republik{s}+indonesia{s}*)+')"
    return (
        f"CAST(coalesce(list_sum(list_transform(list_filter("
        f"regexp_split_to_array({e}, '{_BREAK}'), lambda l: {keep}), lambda l: {_words('l')})), 0) AS INTEGER)"
    )


# --- extraction from normalised text ---------------------------------------------

_CH = r"[A-Za-z0-9\s\.,\-/]"


def _unique(e):
    return f"list_filter({e}, lambda x, i: list_position({e}, x) = i)"


def _all(e, pattern, group=0):
    return f"regexp_extract_all({e}, {_lit(pattern)}, {group})"


def _found_names(e, party):
    patterns = (
        rf"(?i)([A-Z]{_CH}+?)\s*,?\s*selanjutnya\s+disebut\s+(?:sebagai\s+)?{party}",
        rf"(?i)([A-Z]{_CH}+?)\s*(?:dalam hal ini diwakili\s+oleh\s+.+?)?\s*sebagai\s+{party}",
        rf"(?i){party}\s*(?:adalah|:)?\s*([A-Z]{_CH}{{3,60}})",
    )
    lists = ", ".join(_all(e, p, 1) for p in patterns)
    return (
        f"list_filter(list_transform(flatten([{lists}]), lambda n: {_strip('n')}), "
        "lambda n: length(n) > 3)"
    )


def _single_name(e, party, alias):
    found = _all(e, rf"(?i)(?:{party}|{alias})\s*[:\-]?\s*([A-Z][A-Za-z\s\.]{{3,50}})", 1)
    return f"list_transform({found}[1:1], lambda n: {_strip('n')})"


def _party_count(e, names, party):
    times = f"len(regexp_extract_all({e}, '{party}')) - len(regexp_extract_all({e}, '{party}:'))"
    return f"CASE WHEN len({names}) = 0 THEN 0 ELSE greatest(1, len({names}), least(({times}) // 3, 10)) END"


_STATUTES = (
    r"(?i)pasal\s+\d+(?:\s+ayat\s+\(\d+\))?\s+(?:jo\.?\s+pasal\s+\d+\s+)?[A-Za-z\.]+(?:\s+\d{4})?",
    r"(?i)pasal\s+\d+(?:\s*[,/]\s*\d+)*\s+[A-Za-z\.]+",
    r"(?i)pasal\s+\d+\s+huruf\s+[a-z]\s+[A-Za-z\.]+",
)


def _section(e, pattern, least):
    body = _strip(f"regexp_extract({e}, {_lit('(?i)' + pattern)}, 1)")
    return f"CASE WHEN {_words(body)} > {least} THEN substring({body}, 1, 800) END"


def _facts(e):
    clause = r"(?is)menimbang\s*[:,]?\s*(.*?)(?:menimbang|mengadili|memutus)"
    first = f"substring({_strip(f'regexp_extract({e}, {_lit(clause)}, 1)')}, 1, 800)"
    lines = f"list_filter(list_transform(string_split({e}, chr(10)), lambda l: {_strip('l')}), lambda l: length(l) > 50)"
    rest = f"substring(CASE WHEN len({lines}) > 0 THEN coalesce(array_to_string({lines}[3:7], ' '), '') ELSE {e} END, 1, 800)"
    sections = [
        _section(e, p, 30)
        for p in (
            r"duduk\s+perkara\s*\n+((?:.+\n?){1,15})",
            r"posita\s*\n+((?:.+\n?){1,15})",
            r"tentang\s+duduk\s+perkara\s*\n+((?:.+\n?){1,15})",
            r"kronologi\s*\n+((?:.+\n?){1,10})",
        )
    ]
    return (
        f"coalesce({', '.join(sections)}, CASE WHEN regexp_matches({e}, {_lit(clause)}) THEN {first} END, {rest})"
    )


def _arguments(e):
    marked = f"regexp_replace({e}, 'menimbang', chr(1) || 'menimbang', 'gi')"
    clause = r"(?is)menimbang\s*,?\s*bahwa\s+(.+?)(?:\x01|mengadili|;|\n\n)"
    parts = f"list_transform({_all(marked, clause, 1)}[1:3], lambda c: {_strip('replace(c, chr(1), ' + _lit('') + ')')})"
    sections = [
        _section(e, p, 20)
        for p in (
            r"pertimbangan\s+hukum\s*\n+((?:.+\n?){1,20})",
            r"pertimbangan\s+majelis\s*\n+((?:.+\n?){1,20})",
        )
    ]
    return f"coalesce({', '.join(sections)}, substring(coalesce(array_to_string({parts}, ' | '), ''), 1, 800))"


def _decision(*sources):
    whens = []
    for e in sources:
        whens += [
            f"WHEN contains({e}, 'dikabulkan untuk seluruhnya') OR contains({e}, 'dikabulkan seluruhnya') THEN 'dikabulkan_seluruhnya'",
            f"WHEN contains({e}, 'dikabulkan untuk sebagian') OR contains({e}, 'dikabulkan sebagian') THEN 'dikabulkan_sebagian'",
            f"WHEN contains({e}, 'ditolak') OR contains({e}, 'tidak dapat diterima') THEN 'ditolak'",
            f"WHEN contains({e}, 'gugur') THEN 'gugur'",
            f"WHEN contains({e}, 'dikabulkan') THEN 'dikabulkan'",
        ]
    return f"CASE {' '.join(whens)} ELSE 'lainnya' END"


def _merged(e):
    return (
        f"CASE WHEN starts_with({e}, 'dikabulkan') THEN 'dikabulkan' WHEN {e} IN ('ditolak', "
        f"'tidak dapat diterima', 'niet_ontvankelijke_verklaard') THEN 'ditolak' ELSE 'lainnya' END"
    )


# --- shared relations -----------------------------------------------------------------


def _split_of(prefix, source, key):
    """Stratified split of ``source`` (key, label) as ``<prefix>_split``."""
    return {
        f"{prefix}_sizes": f"SELECT label, count(*) AS n_class FROM {source} GROUP BY label",
        f"{prefix}_shares": f"""SELECT label, n_class, sum(n_class) OVER () AS n, min(n_class) OVER () >= 2 AS stratified,
            CAST(ceil(sum(n_class) OVER () * 0.2::DOUBLE) AS BIGINT) AS n_test FROM {prefix}_sizes""",
        f"{prefix}_based": f"SELECT *, n_class * n_test // n AS base, n_class * n_test % n AS rest FROM {prefix}_shares",
        f"{prefix}_quotas": f"""SELECT label, n_class, stratified, n_test, CAST(base + CASE WHEN row_number() OVER
            (ORDER BY rest DESC, label) <= n_test - sum(base) OVER () THEN 1 ELSE 0 END AS BIGINT) AS quota
            FROM {prefix}_based""",
        f"{prefix}_split": f"""SELECT s.{key}, s.label, CASE WHEN row_number() OVER (PARTITION BY s.label
            ORDER BY md5(CAST(s.{key} AS VARCHAR) || ':42'), s.{key}) <= q.quota THEN 'test' ELSE 'train' END AS split
            FROM {source} s JOIN {prefix}_quotas q ON s.label = q.label""",
    }


def _tfidf(prefix, source, key, text):
    """Vocabulary and weights of ``source`` under the prefix."""
    return {
        **_counted(prefix, source, key, text),
        f"{prefix}_terms": f"""SELECT term, count(*) AS df, sum(tf) AS cf FROM {prefix}_counts GROUP BY term
            HAVING count(*) >= 2 ORDER BY cf DESC, term LIMIT 10000""",
        f"{prefix}_vocab": f"""SELECT term, CAST(row_number() OVER (ORDER BY term) - 1 AS INTEGER) AS idx, df,
            CAST(cf AS BIGINT) AS cf,
            ln((1 + (SELECT count(*) FROM {source}))::DOUBLE / (1 + df)) + 1 AS idf FROM {prefix}_terms""",
        **_weighted(prefix, prefix, key),
    }


def _counted(prefix, source, key, text):
    return {
        f"{prefix}_tokens": f"SELECT {key}, regexp_extract_all(lower({text}), '[\\p{{L}}\\p{{N}}_]{{2,}}') AS t FROM {source}",
        f"{prefix}_counts": f"""SELECT {key}, term, count(*) AS tf FROM (SELECT {key}, unnest(list_concat(t,
            list_transform(range(1, len(t)), lambda i: t[i] || ' ' || t[i + 1]))) AS term FROM {prefix}_tokens)
            GROUP BY {key}, term""",
    }


def _weighted(prefix, vocab, key):
    return {
        f"{prefix}_raw": f"""SELECT c.{key}, v.idx, (1 + ln(c.tf)) * v.idf AS w FROM {prefix}_counts c
            JOIN {vocab}_vocab v ON c.term = v.term""",
        f"{prefix}_weights": f"""SELECT {key}, idx, w / sqrt(sum(w * w) OVER (PARTITION BY {key})) AS weight
            FROM {prefix}_raw""",
    }


def _ranked(name, queries, query_key, docs, doc_key, sims, same=True, k=5):
    """Top-k over all pairs, absent similarities as 0."""
    where = "" if same else f"WHERE q.{query_key} <> d.{doc_key}"
    return {
        name: f"""SELECT query_id, doc_id, sim, CAST(rank AS INTEGER) AS rank FROM (
            SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY sim DESC, doc_id) AS rank FROM (
            SELECT q.{query_key} AS query_id, d.{doc_key} AS doc_id, round_even(coalesce(s.sim, 0), 9) AS sim
            FROM {queries} q CROSS JOIN {docs} d LEFT JOIN {sims} s ON s.q = q.{query_key} AND s.d = d.{doc_key}
            {where})) WHERE rank <= {k}"""
    }


def _dots(name, left, left_key, right, right_key):
    return {
        name: f"""SELECT a.{left_key} AS q, b.{right_key} AS d, sum(a.weight * b.weight) AS sim
            FROM {left} a JOIN {right} b ON a.idx = b.idx GROUP BY 1, 2"""
    }


def _cosines(name, left, left_key, right, right_key):
    return {
        name: f"""SELECT a.{left_key} AS q, b.{right_key} AS d,
            list_cosine_similarity(a.embedding::DOUBLE[], b.embedding::DOUBLE[]) AS sim FROM {left} a, {right} b"""
    }


def _at_k(name, model, queries, near, known):
    """Retrieval metrics; ``queries`` (query_id, label), ``known`` (doc_id, label)."""
    return {
        name: f"""SELECT '{model}' AS model, round_even(avg(CASE WHEN tp > 0 THEN 1 ELSE 0 END), 4) AS accuracy,
            round_even(avg(p), 4) AS precision, round_even(avg(r), 4) AS recall,
            round_even(avg(CASE WHEN p + r > 0 THEN 2 * p * r / (p + r) ELSE 0 END), 4) AS f1 FROM (
            SELECT tp, tp / 5.0::DOUBLE AS p, tp::DOUBLE / rel AS r FROM (
            SELECT q.query_id, (SELECT count(*) - 1 FROM {known} x WHERE x.label = q.label) AS rel,
              (SELECT count(*) FROM {near} n JOIN {known} x ON x.doc_id = n.doc_id
               WHERE n.query_id = q.query_id AND x.label = q.label) AS tp FROM {queries} q) WHERE rel > 0)"""
    }


_N = "normalised"
_CTES = {
    "case_view": CASE_VIEW.format(documents="documents", labels="labels"),
    "detail_view": DETAIL_VIEW.format(pages="pages"),
    "counted": f"SELECT *, {_words('raw_text')} AS raw_words FROM case_view",
    "cleaned_view": f"SELECT *, CASE WHEN raw_words >= 50 THEN {_clean('raw_text')} ELSE '' END AS cleaned FROM counted",
    "scored": f"SELECT *, {_words('cleaned')} AS jumlah_kata, {_content_words('raw_text')} AS content FROM cleaned_view",
    "measured": """SELECT * EXCLUDE (score), CAST(round_even(score, 4) AS DOUBLE) AS keutuhan_teks,
        jumlah_kata >= 100 AND score >= 0.5 AS valid_min_200_kata,
        CASE WHEN raw_text = '' THEN 'no_text' WHEN raw_words < 50 THEN 'scan_skip' ELSE 'text' END AS status FROM (
        SELECT *, CASE WHEN jumlah_kata = 0 OR content = 0 THEN 0.0::DOUBLE
          ELSE least(jumlah_kata::DOUBLE / content, 1.0::DOUBLE) END AS score FROM scored)""",
    "normal": f"SELECT *, {_normalise('cleaned')} AS normalised FROM measured",
    "valid": "SELECT * FROM normal WHERE valid_min_200_kata AND normalised <> ''",
    "parties": f"""SELECT *, {_party_count(_N, 'pn', 'penggugat')} AS num_p, {_party_count(_N, 'dn', 'tergugat')} AS num_d FROM (
        SELECT * EXCLUDE (p0, d0),
          CASE WHEN len(p0) > 0 THEN ({_unique('p0')})[1:5] ELSE {_single_name(_N, 'penggugat', 'pemohon')} END AS pn,
          CASE WHEN len(d0) > 0 THEN ({_unique('d0')})[1:5] ELSE {_single_name(_N, 'tergugat', 'termohon')} END AS dn FROM (
        SELECT *, {_found_names(_N, 'penggugat')} AS p0, {_found_names(_N, 'tergugat')} AS d0 FROM valid))""",
    "statutes": f"""SELECT case_id, coalesce(array_to_string(list_transform(firsts[1:10], lambda i: raw[i]), ', '), '') AS pasal FROM (
        SELECT case_id, raw, list_filter(range(1, len(raw) + 1), lambda i: length(keys[i]) > 5
          AND list_position(keys, keys[i]) = i) AS firsts FROM (
        SELECT *, list_transform(raw, lambda r: regexp_replace(lower(r), '\\s+', ' ', 'g')) AS keys FROM (
        SELECT case_id, list_transform(flatten([{', '.join(_all(_N, p) for p in _STATUTES)}]),
          lambda r: {_strip('r')}) AS raw FROM valid)))""",
    "cases": f"""SELECT p.case_id, no_perkara, tanggal_register AS tanggal, jenis_perkara, pengadilan, hakim_ketua,
        klasifikasi, CASE WHEN len(pn) > 0 THEN array_to_string(pn, '; ') ELSE 'tidak terdeteksi' END AS penggugat,
        CASE WHEN len(dn) > 0 THEN array_to_string(dn, '; ') ELSE 'tidak terdeteksi' END AS tergugat,
        CAST(num_p AS INTEGER) AS num_penggugat, CAST(num_d AS INTEGER) AS num_tergugat,
        {_facts(_N)} AS ringkasan_fakta, {_arguments(_N)} AS argumen_hukum, s.pasal, amar AS amar_putusan,
        {_decision('lower(amar)', 'lower(normalised)')} AS decision_type, jumlah_kata,
        CAST(len({_tokens(_N)}) AS INTEGER) AS jumlah_token, replace(substring(normalised, 1, 5000), chr(10), ' ') AS text_full,
        'data/raw/' || p.case_id || '.txt' AS raw_file_path
        FROM parties p JOIN statutes s ON p.case_id = s.case_id""",
    "features": f"""SELECT case_id, no_perkara, jumlah_kata, ringkasan_fakta, amar_putusan, text_full, {_merged('decision_type')} AS label,
        {_strip("lower(ringkasan_fakta || ' ' || argumen_hukum || ' ' || pasal || ' ' || amar_putusan)")} AS text_combined FROM cases""",
    "labelled": f"""SELECT doc_id, case_id, amar, {_merged('d')} AS label FROM (
        SELECT *, {_decision('lower(amar)')} AS d FROM case_view)""",
    "raw_ids": "SELECT DISTINCT 'case_' || md5(CAST(doc_id AS VARCHAR)) AS case_id FROM labels",
    "token_ids": "SELECT DISTINCT 'case_' || md5(CAST(conv_id AS VARCHAR)) AS case_id FROM conversations",
    "archive_ids": "SELECT DISTINCT 'case_' || md5(CAST(vec_id AS VARCHAR)) AS case_id FROM embeddings",
    "missing": """SELECT 'raw' AS inventory, case_id FROM measured WHERE valid_min_200_kata AND case_id NOT IN (FROM raw_ids)
        UNION ALL SELECT 'tokens', case_id FROM measured WHERE valid_min_200_kata AND case_id NOT IN (FROM token_ids)
        UNION ALL SELECT 'archive', case_id FROM measured WHERE valid_min_200_kata AND case_id NOT IN (FROM archive_ids)""",
    "copies": """SELECT no_perkara, case_id, n_copies FROM (SELECT no_perkara, case_id,
        count(*) OVER (PARTITION BY no_perkara) AS n_copies FROM case_view WHERE no_perkara <> '') WHERE n_copies > 1""",
    **_split_of("ls", "labelled", "case_id"),
    **_tfidf("dt", "documents", "doc_id", "text"),
    "asked": f"SELECT item_id AS query_id, {_strip('lower(text)')} AS query_text FROM benchmark",
    **_counted("qt", "asked", "query_id", "query_text"),
    **_weighted("qt", "dt", "query_id"),
    **_dots("qd", "qt_weights", "query_id", "dt_weights", "doc_id"),
    "asked_some": "SELECT * FROM asked WHERE query_text <> ''",
    **_ranked("near_docs", "asked_some", "query_id", "documents", "doc_id", "qd"),
    "train_docs": f"""SELECT l.doc_id, CASE WHEN trim(l.amar) <> '' THEN trim(l.amar)
        WHEN {_strip("coalesce(f.ringkasan_fakta, '')")} <> '' THEN {_strip('f.ringkasan_fakta')} ELSE l.label END AS solution
        FROM labelled l JOIN ls_split s ON l.case_id = s.case_id LEFT JOIN features f ON l.case_id = f.case_id WHERE s.split = 'train'""",
    **_ranked("near_train_ids", "asked_some", "query_id", "train_docs", "doc_id", "qd"),
    "near_train": "SELECT n.*, t.solution FROM near_train_ids n JOIN train_docs t ON n.doc_id = t.doc_id",
    "votes": """SELECT query_id, solution, count(*) AS n, round(sum(sim), 9) AS total, max(sim) AS best,
        min(rank) AS early FROM near_train WHERE solution <> '' GROUP BY query_id, solution""",
    "weighted": """SELECT query_id, solution FROM (SELECT *, row_number() OVER (PARTITION BY query_id
        ORDER BY total DESC, best DESC, early) AS o FROM votes) WHERE o = 1""",
    "majority": """SELECT query_id, solution FROM (SELECT *, row_number() OVER (PARTITION BY query_id
        ORDER BY n DESC, total DESC, early) AS o FROM votes) WHERE o = 1""",
    **_split_of("cs", "features", "case_id"),
    **_tfidf("ct", "features", "case_id", "text_combined"),
    "case_test": "SELECT case_id, label FROM cs_split WHERE split = 'test'",
    "test_weights": "SELECT w.* FROM ct_weights w JOIN case_test t ON w.case_id = t.case_id",
    **_dots("cc", "test_weights", "case_id", "ct_weights", "case_id"),
    **_ranked("near_cases", "case_test", "case_id", "features", "case_id", "cc", same=False),
    "sampled": f"""SELECT 'q_' || substring(f.case_id, 1, 20) AS query_id, f.case_id, f.no_perkara, t.label,
        substring(CASE WHEN {_strip('f.ringkasan_fakta')} <> '' THEN f.ringkasan_fakta ELSE f.text_full END, 1, 500) AS query_text FROM features f JOIN case_test t ON f.case_id = t.case_id
        ORDER BY md5(f.case_id || ':42'), f.case_id LIMIT 10""",
    "expected": """SELECT case_id, coalesce(string_agg(other, '|' ORDER BY other), '') AS expected FROM (
        SELECT s.case_id, t.case_id AS other, row_number() OVER (PARTITION BY s.case_id ORDER BY t.case_id) AS o
        FROM sampled s LEFT JOIN case_test t ON t.label = s.label AND t.case_id <> s.case_id) WHERE o <= 5 GROUP BY case_id""",
    "sampled_texts": f"SELECT query_id, {_strip('lower(query_text)')} AS query_text FROM sampled",
    **_counted("st", "sampled_texts", "query_id", "query_text"),
    **_weighted("st", "ct", "query_id"),
    **_dots("sd", "st_weights", "query_id", "ct_weights", "case_id"),
    "sampled_some": "SELECT * FROM sampled_texts WHERE query_text <> ''",
    **_ranked("near_sampled", "sampled_some", "query_id", "features", "case_id", "sd"),
    "stored": "SELECT 'case_' || md5(CAST(vec_id AS VARCHAR)) AS case_id, embedding FROM embeddings",
    "sampled_vecs": "SELECT s.query_id, v.embedding FROM sampled s JOIN stored v ON s.case_id = v.case_id",
    **_cosines("sv", "sampled_vecs", "query_id", "stored", "case_id"),
    **_ranked("near_vecs", "sampled_vecs", "query_id", "stored", "case_id", "sv"),
    "records": """SELECT s.query_id, s.case_id, s.no_perkara, s.label AS decision_type, s.query_text,
        s.case_id AS ground_truth_case_id, e.expected AS expected_similar_case_ids,
        coalesce((SELECT string_agg(doc_id, '|' ORDER BY rank) FROM near_sampled n WHERE n.query_id = s.query_id), '') AS top5_tfidf,
        coalesce((SELECT string_agg(doc_id, '|' ORDER BY rank) FROM near_vecs n WHERE n.query_id = s.query_id), '') AS top5_bert
        FROM sampled s JOIN expected e ON s.case_id = e.case_id""",
    "hits": """SELECT query_id, case_id, decision_type,
        list_contains(string_split(top5_tfidf, '|'), ground_truth_case_id) AS hit_tfidf,
        list_contains(string_split(top5_bert, '|'), ground_truth_case_id) AS hit_bert,
        replace(top5_tfidf, '|', ', ') AS top5_tfidf, replace(top5_bert, '|', ', ') AS top5_bert FROM records""",
    # naive Bayes: a dense grid of train rows and terms, as in the textbook
    "train_case": "SELECT case_id, label FROM cs_split WHERE split = 'train'",
    "train_weights": "SELECT t.label, w.* FROM ct_weights w JOIN train_case t ON w.case_id = t.case_id",
    "scale": """SELECT v.idx, CASE WHEN count(w.weight) < (SELECT count(*) FROM train_case) THEN 0 ELSE min(w.weight) END AS low,
        coalesce(max(w.weight), 0) AS high FROM ct_vocab v LEFT JOIN train_weights w ON v.idx = w.idx GROUP BY v.idx""",
    "spans": "SELECT idx, low, CASE WHEN high = low THEN 1 ELSE high - low END AS range FROM scale",
    "scaled": "SELECT w.label, w.idx, sum((w.weight - s.low) / s.range) AS x FROM train_weights w JOIN spans s ON w.idx = s.idx GROUP BY 1, 2",
    "class_sizes": "SELECT label, count(*) AS n, row_number() OVER (ORDER BY label) AS code FROM train_case GROUP BY label",
    "mass": "SELECT c.label, s.idx, coalesce(x.x, 0) + 0.1::DOUBLE AS x FROM class_sizes c CROSS JOIN spans s LEFT JOIN scaled x ON x.label = c.label AND x.idx = s.idx",
    "logp": "SELECT label, idx, ln(x) - ln(sum(x) OVER (PARTITION BY label)) AS logp FROM mass",
    "evidence": """SELECT t.case_id, l.label, sum((coalesce(w.weight, 0) - s.low) / s.range * l.logp) AS e
        FROM case_test t CROSS JOIN spans s JOIN logp l ON l.idx = s.idx
        LEFT JOIN test_weights w ON w.case_id = t.case_id AND w.idx = s.idx
        WHERE w.weight IS NOT NULL OR s.low > 0 GROUP BY 1, 2""",
    "scores": """SELECT t.case_id, t.label AS true_label, c.label, c.code,
        round(ln(c.n::DOUBLE / (SELECT count(*) FROM train_case)) + coalesce(e.e, 0), 6) AS score
        FROM case_test t CROSS JOIN class_sizes c LEFT JOIN evidence e ON e.case_id = t.case_id AND e.label = c.label""",
    "pred": """SELECT case_id, true_label, label AS pred_label, score FROM (SELECT *, row_number() OVER
        (PARTITION BY case_id ORDER BY score DESC, code) AS o FROM scores) WHERE o = 1""",
    "label_names": "SELECT true_label AS label FROM pred UNION SELECT pred_label FROM pred",
    "per_class": """SELECT label, tp, support, p, r, CASE WHEN p + r > 0 THEN 2 * p * r / (p + r) ELSE 0 END AS f FROM (
        SELECT label, tp, support, CASE WHEN predicted > 0 THEN tp::DOUBLE / predicted ELSE 0 END AS p,
          CASE WHEN support > 0 THEN tp::DOUBLE / support ELSE 0 END AS r FROM (
        SELECT label, count(*) FILTER (true_label = label AND pred_label = label) AS tp,
          count(*) FILTER (true_label = label) AS support, count(*) FILTER (pred_label = label) AS predicted
        FROM label_names CROSS JOIN pred GROUP BY label))""",
    "clf": """SELECT 'Naive Bayes' AS model, round_even(sum(tp)::DOUBLE / sum(support), 4) AS accuracy,
        round_even(sum(p * support) / sum(support), 4) AS precision, round_even(sum(r * support) / sum(support), 4) AS recall,
        round_even(sum(f * support) / sum(support), 4) AS f1 FROM per_class""",
    "wrong": """SELECT p.case_id, p.true_label, p.pred_label, f.no_perkara, f.jumlah_kata FROM pred p
        JOIN features f ON p.case_id = f.case_id WHERE p.true_label <> p.pred_label""",
    "vecs": "SELECT vec_id, embedding, CAST(label AS VARCHAR) AS label FROM embeddings",
    **_cosines("vv", "vecs", "vec_id", "vecs", "vec_id"),
    **_split_of("vs", "vecs", "vec_id"),
    "vec_test": "SELECT vec_id FROM vs_split WHERE split = 'test'",
    **_ranked("near_test_vecs", "vec_test", "vec_id", "vecs", "vec_id", "vv", same=False),
    "case_queries": "SELECT case_id AS query_id, label FROM case_test",
    "case_known": "SELECT case_id AS doc_id, label FROM features",
    **_at_k("sparse_at_k", "TF-IDF + Cosine", "case_queries", "near_cases", "case_known"),
    "vec_queries": "SELECT vec_id AS query_id, label FROM vs_split WHERE split = 'test'",
    "vec_known": "SELECT vec_id AS doc_id, label FROM vecs",
    **_at_k("dense_at_k", "Dense + Cosine", "vec_queries", "near_test_vecs", "vec_known"),
    "comparison": """SELECT *, 'classification' AS type FROM clf UNION ALL SELECT *, 'retrieval' FROM sparse_at_k
        UNION ALL SELECT *, 'retrieval' FROM dense_at_k""",
}


def _statement(select):
    """The select with the shared relations it needs, in order."""
    needed, open_ = set(), [select]
    while open_:
        for name in re.findall(r"\w+", open_.pop()):
            if name in _CTES and name not in needed:
                needed.add(name)
                open_.append(_CTES[name])
    ctes = [f"{name} AS ({_CTES[name]})" for name in _CTES if name in needed]
    return (f"WITH {', '.join(ctes)} " if ctes else "") + select


def _near(name, extra=""):
    return f"SELECT query_id, doc_id, round(sim, 6) AS sim, rank{extra} FROM {name}"


def _distribution(column):
    return (
        f"SELECT round(avg({column}), 6) AS mean, round(median({column})::DOUBLE, 6) AS median, "
        f"min({column})::DOUBLE AS min, max({column})::DOUBLE AS max, "
        f"round(stddev_samp({column}), 6) AS std FROM measured"
    )


def _tagless(e):
    """Text of a fragment: the pieces between tags, each stripped, joined."""
    piece = "x"
    for name, ch in (("&nbsp;", "\u00a0"), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"),
                     ("&eacute;", "é"), ("&#233;", "é"), ("&#xE9;", "é"), ("&hellip;", "…"), ("&amp;", "&")):
        piece = f"replace({piece}, {_lit(name)}, {_lit(ch)})"
    return (
        f"coalesce(array_to_string(list_transform(regexp_split_to_array({e}, '<[^>]*>'), "
        f"lambda x: {_strip(piece)}), ''), '')"
    )


def _visible(e):
    return _rep(e, r"(?is)<!--.*?-->|<script\b.*?</script\s*>|<style\b.*?</style\s*>", "")


_HREF = r"""(?is)<a\s(?:[^>]*?\s)?href\s*=\s*["']([^"']*)["']"""
_CTES |= {
    "page_targets": f"""SELECT page_id, list_filter(list_transform({_all(_visible('html'), _HREF, 1)},
        lambda t: replace(t, '&amp;', '&')), lambda t: starts_with(t, '/')) AS targets FROM pages""",
    "page_link_rows": """SELECT page_id, unnest(targets) AS url, generate_subscripts(targets, 1) - 1 AS pos FROM page_targets
        WHERE page_id < coalesce((SELECT min(page_id) FROM page_targets WHERE len(targets) = 0), 9223372036854775807)""",
    "detail_ids": r"""SELECT *, 'case_' || CASE WHEN regexp_matches(url, '/direktori/putusan/[a-zA-Z0-9\-]+\.html')
        THEN right(regexp_extract(url, '/direktori/putusan/([a-zA-Z0-9\-]+)\.html', 1), 40)
        WHEN page_id < 1000 THEN lpad(CAST(page_id AS VARCHAR), 3, '0') ELSE CAST(page_id AS VARCHAR) END AS case_id FROM detail_view""",
    "detail_tokens": rf"""SELECT page_id, i, t, sum(CASE WHEN regexp_matches(t, '(?i)^<table\b') THEN 1
        WHEN regexp_matches(t, '(?i)^</table\b') THEN -1 ELSE 0 END) OVER (PARTITION BY page_id ORDER BY i) AS depth
        FROM (SELECT page_id, unnest(ts) AS t, generate_subscripts(ts, 1) AS i FROM (
            SELECT page_id, regexp_extract_all({_visible('html')}, '(?s)</?[A-Za-z!?][^>]*>|[^<]+|<') AS ts FROM detail_ids))""",
    "table_starts": """SELECT page_id, min(i) AS s, min_by(depth, i) AS d FROM detail_tokens
        WHERE t = '<table class="table table-case">' GROUP BY page_id""",
    "table_tokens": """SELECT t.*, s.d FROM detail_tokens t JOIN table_starts s ON t.page_id = s.page_id AND t.i > s.s AND t.i <
        (SELECT min(e.i) FROM detail_tokens e WHERE e.page_id = s.page_id AND e.i > s.s AND e.depth < s.d)""",
    "heads": "SELECT page_id, min(i) FILTER (t = '<h2>') AS a, min(i) FILTER (t = '</h2>') AS b FROM table_tokens GROUP BY page_id",
    "cell_tokens": """SELECT t.* FROM table_tokens t JOIN heads h ON t.page_id = h.page_id AND NOT coalesce(t.i BETWEEN h.a AND h.b, false)""",
    "cell_spans": r"""SELECT a.page_id, a.i, coalesce(min(b.i), 1000000000) AS z FROM cell_tokens a LEFT JOIN cell_tokens b
        ON a.page_id = b.page_id AND b.i > a.i
        AND ((regexp_matches(b.t, '(?i)^</?(?:td|th|tr)\b') AND b.depth = a.depth) OR b.depth < a.depth)
        WHERE regexp_matches(a.t, '(?i)^<td\b') GROUP BY a.page_id, a.i""",
    "cell_texts": """SELECT s.page_id, s.i, coalesce(string_agg(t.t, '' ORDER BY t.i), '') AS td FROM cell_spans s
        LEFT JOIN cell_tokens t ON t.page_id = s.page_id AND t.i > s.i AND t.i < s.z GROUP BY s.page_id, s.i""",
    "detail_cells": """SELECT d.*, tab, tds FROM detail_ids d
        JOIN (SELECT page_id, string_agg(t, '' ORDER BY i) AS tab FROM table_tokens GROUP BY page_id) USING (page_id)
        JOIN (SELECT page_id, list(td ORDER BY i) AS tds FROM cell_texts GROUP BY page_id) USING (page_id)""",
}


def _field(name, label):
    at = f"list_position(list_transform(tds, lambda t: contains(regexp_replace(t, '<[^>]*>', '', 'g'), {_lit(label)})), true)"
    return f"CASE WHEN {at} > 0 THEN {_tagless(f'coalesce(tds[{at} + 1], {_lit(str())})')} ELSE '' END AS {name}"


_FIELDS = ", ".join(_field(name, label) for name, label in P.PAGE_FIELDS)
_JUDUL = _tagless("regexp_extract(tab, '(?is)<h2>(.*?)</h2>', 1)") + " AS judul"

_ISSUES = """SELECT * FROM (
        SELECT CASE WHEN n < 30 THEN 'valid_below_required' WHEN n < 90 THEN 'valid_below_target' END AS issue, n
          FROM (SELECT count(*) FILTER (valid_min_200_kata) AS n FROM measured)
        UNION ALL SELECT 'valid_without_text', count(*) FROM missing WHERE inventory = 'raw'
        UNION ALL SELECT 'valid_without_tokens', count(*) FROM missing WHERE inventory = 'tokens'
        UNION ALL SELECT 'duplicated_key_rows', count(*) FROM copies
        UNION ALL SELECT 'retired_category_rows', count(*) FROM case_view WHERE contains(lower(jenis_perkara), 'senjata api'))
        WHERE issue IS NOT NULL AND n > 0"""

_SELECTS = {
    "text_clean": f"SELECT doc_id, {_clean('raw_text')} AS cleaned FROM case_view",
    "text_normalize": f"SELECT doc_id, {_normalise(_clean('raw_text'))} AS normalised FROM case_view",
    "text_tokens": f"SELECT doc_id, coalesce(array_to_string({_tokens('text')}, ' '), '') AS tokens FROM documents",
    "text_counts": f"SELECT doc_id, {_words('text')} AS n_words, CAST(len({_tokens('text')}) AS INTEGER) AS n_tokens FROM documents",
    "text_completeness": f"""SELECT doc_id, content AS content_words, CAST(round_even(CASE WHEN kept = 0 OR content = 0 THEN 0.0::DOUBLE
        ELSE least(kept::DOUBLE / content, 1.0::DOUBLE) END, 4) AS DOUBLE) AS keutuhan_teks FROM (SELECT doc_id,
        {_content_words('raw_text')} AS content, {_words(_clean('raw_text'))} AS kept FROM case_view)""",
    "text_valid": f"""SELECT case_id, jumlah_kata, CAST(len({_tokens(_N)}) AS INTEGER) AS jumlah_token, keutuhan_teks,
        valid_min_200_kata FROM normal""",
    "text_scan_skip": "SELECT case_id, raw_words, status, jumlah_kata FROM measured",
    "take_until_valid": """SELECT case_id, doc_id AS seq, valid_min_200_kata FROM (SELECT *,
        (SELECT count(*) FROM measured WHERE valid_min_200_kata AND case_id IN (FROM raw_ids))
        + coalesce(sum(CASE WHEN valid_min_200_kata THEN 1 ELSE 0 END) OVER (ORDER BY doc_id
          ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS seen
        FROM measured WHERE case_id NOT IN (FROM raw_ids)) WHERE seen < (SELECT count(*) FROM labels) + 90""",
    "dedup_keep_longest": """SELECT case_id, no_perkara, jumlah_kata FROM (SELECT *, row_number() OVER
        (PARTITION BY no_perkara ORDER BY jumlah_kata DESC, case_id) AS o FROM measured) WHERE no_perkara = '' OR o = 1""",
    "corpus_summary": """SELECT count(*) AS n_rows, count(*) FILTER (valid_min_200_kata) AS n_valid,
        count(*) FILTER (jumlah_kata = 0 AND url_pdf <> '') AS n_scan_skip FROM measured""",
    "page_links": """SELECT url, page_id AS first_page, CAST(pos AS INTEGER) AS first_pos FROM (SELECT *, row_number() OVER
        (PARTITION BY url ORDER BY page_id, pos) AS o FROM page_link_rows) WHERE o = 1 ORDER BY first_page, first_pos LIMIT 1000""",
    "page_heading": f"""SELECT page_id,
        {_tagless("regexp_extract(" + _visible("html") + ", '(?is)<h1[^>]*>(.*?)</h1>', 1)")} AS heading,
        {_tagless("regexp_extract(" + _visible("html") + ", '(?is)<title[^>]*>(.*?)</title>', 1)")} AS title FROM pages""",
    "page_ids": "SELECT page_id, case_id FROM detail_ids",
    "page_fields": f"SELECT case_id, {_JUDUL}, {_FIELDS} FROM detail_cells",
    "page_record": f"""SELECT c.case_id, c.judul, 'Perdata - Perbuatan Melawan Hukum (PMH)' AS jenis_perkara, 'PN Bandung' AS pengadilan,
        c.url_detail, c.url_pdf, coalesce(n.jumlah_kata, 0) AS jumlah_kata, coalesce(CAST(len({_tokens('n.' + _N)}) AS INTEGER), 0) AS jumlah_token,
        coalesce(n.keutuhan_teks, 0) AS keutuhan_teks, coalesce(n.valid_min_200_kata, false) AS valid_min_200_kata,
        {", ".join("c." + name for name, _ in P.PAGE_FIELDS)} FROM (SELECT page_id, case_id, {_JUDUL}, url AS url_detail,
        coalesce(list_filter({_all(_visible('html'), _HREF, 1)}, lambda t: contains(t, '/pdf/'))[1], '') AS url_pdf, {_FIELDS}
        FROM detail_cells) c LEFT JOIN normal n ON n.doc_id = c.page_id""",
    "qa_counts": """SELECT n_total, n_valid, n_total - n_valid AS n_invalid, CASE WHEN n_valid >= 90 THEN 'OK'
        WHEN n_valid >= 30 THEN 'WARN' ELSE 'FAIL' END AS status FROM (SELECT count(*) AS n_total,
        count(*) FILTER (valid_min_200_kata) AS n_valid FROM measured)""",
    "qa_inventory_missing": "SELECT inventory, case_id FROM missing",
    "qa_inventory_sizes": """SELECT 'raw' AS inventory, count(*) AS n_ids FROM raw_ids UNION ALL
        SELECT 'tokens', count(*) FROM token_ids UNION ALL SELECT 'archive', count(*) FROM archive_ids""",
    "qa_lengths": _distribution("jumlah_kata"),
    "qa_completeness": _distribution("keutuhan_teks"),
    "qa_short": """SELECT case_id, jumlah_kata, CASE WHEN jumlah_kata = 0 THEN 'empty' ELSE 'short' END AS kind
        FROM measured WHERE jumlah_kata < 100""",
    "qa_incomplete": "SELECT case_id, keutuhan_teks FROM measured WHERE keutuhan_teks > 0 AND keutuhan_teks < 0.5",
    "qa_duplicates": "SELECT no_perkara, case_id, n_copies FROM copies",
    "qa_missing_rate": " UNION ALL ".join(
        f"""SELECT '{c}' AS column_name, count(*) FILTER ({c} IS NULL OR {c} = '') AS n_empty, count(*) AS n_total,
        round(100.0::DOUBLE * count(*) FILTER ({c} IS NULL OR {c} = '') / count(*), 4) AS pct_empty,
        CASE WHEN count(*) FILTER ({c} IS NULL OR {c} = '') / count(*) < 0.1::DOUBLE THEN 'OK' ELSE 'WARN' END AS status FROM case_view"""
        for c in P.CHECKED_COLUMNS
    ),
    "qa_categories": """SELECT jenis_perkara, count(*) AS n_rows, contains(lower(jenis_perkara), 'senjata api') AS retired
        FROM case_view GROUP BY jenis_perkara""",
    "qa_sample": f"""SELECT s.case_id, CASE WHEN r.case_id IS NOT NULL THEN {_words(_N)} END AS n_words,
        CASE WHEN r.case_id IS NOT NULL THEN replace(substring(normalised, 1, 300), chr(10), ' ') END AS preview,
        r.case_id IS NULL AS text_missing FROM (SELECT * FROM normal WHERE valid_min_200_kata
        ORDER BY md5(case_id || ':42'), case_id LIMIT 5) s LEFT JOIN raw_ids r ON s.case_id = r.case_id""",
    "qa_issues": _ISSUES,
    "qa_verdict": f"""SELECT count(*) AS n_issues, CASE WHEN count(*) = 0 THEN 'READY' ELSE 'NEEDS_ATTENTION' END AS verdict
        FROM ({_ISSUES})""",
    "qa_flags": """SELECT case_id, string_agg(reason, ';' ORDER BY o) AS alasan_perlu_dicek FROM (
        SELECT case_id, 0 AS o, 'file_raw_hilang' AS reason FROM missing WHERE inventory = 'raw'
        UNION SELECT case_id, 1, 'file_token_hilang' FROM missing WHERE inventory = 'tokens'
        UNION SELECT case_id, 2, 'dokumen_kosong' FROM measured WHERE jumlah_kata = 0
        UNION SELECT case_id, 3, 'keutuhan_di_bawah_80persen' FROM measured WHERE keutuhan_teks > 0 AND keutuhan_teks < 0.5
        UNION SELECT case_id, 4, 'nomor_perkara_duplikat' FROM copies) GROUP BY case_id""",
    "rep_cases": f"""SELECT * EXCLUDE (text_full, raw_file_path), {_words('ringkasan_fakta')} AS panjang_ringkasan_fakta,
        {_words('argumen_hukum')} AS panjang_argumen_hukum, CAST(len(list_filter(string_split(pasal, ','),
        lambda x: trim(x) <> '')) AS INTEGER) AS jumlah_pasal_dirujuk, text_full, raw_file_path FROM cases""",
    "rep_parties": "SELECT case_id, penggugat, tergugat, num_penggugat, num_tergugat FROM cases",
    "rep_statutes": """SELECT case_id, pasal, CAST(len(list_filter(string_split(pasal, ','),
        lambda x: trim(x) <> '')) AS INTEGER) AS jumlah_pasal_dirujuk FROM statutes""",
    "rep_facts": f"SELECT case_id, {_facts(_N)} AS ringkasan_fakta FROM valid",
    "rep_arguments": f"SELECT case_id, {_arguments(_N)} AS argumen_hukum FROM valid",
    "rep_decision": f"SELECT case_id, {_decision('lower(amar)', 'lower(normalised)')} AS decision_type FROM valid",
    "rep_labels": "SELECT decision_type, count(*) AS n_cases FROM cases GROUP BY decision_type",
    "rep_coverage": """SELECT count(*) AS n_cases, count(*) FILTER (penggugat <> 'tidak terdeteksi') AS n_penggugat,
        count(*) FILTER (tergugat <> 'tidak terdeteksi') AS n_tergugat FROM cases""",
    "feature_text": "SELECT case_id, text_combined, label FROM features",
    "label_encode": "SELECT case_id, label, CAST(dense_rank() OVER (ORDER BY label) - 1 AS INTEGER) AS label_encoded FROM labelled",
    "split_stratified": "SELECT case_id, label, split FROM ls_split",
    "split_quotas": "SELECT label, n_class, stratified, n_test, quota FROM ls_quotas",
    "tfidf_vocab": "SELECT term, idx, df, cf, round(idf, 6) AS idf FROM dt_vocab",
    "tfidf_weights": "SELECT doc_id, idx, round(weight, 6) AS weight FROM dt_weights",
    "tfidf_transform": "SELECT query_id, idx, round(weight, 6) AS weight FROM qt_weights",
    "retrieve_sparse": _near("near_docs"),
    "retrieve_dense": _near("near_test_vecs"),
    "self_similarity_topk": _near("near_cases"),
    "retrieve_inverted": _near("near_docs"),
    "self_similarity_inverted": _near("near_cases"),
    "retrieve_chosen_dense": _near("near_test_vecs", ", 'dense' AS method"),
    "retrieve_chosen_sparse": _near("near_docs", ", 'sparse' AS method"),
    "retrieve_approximate_recall": "SELECT count(DISTINCT query_id) AS n_queries, count(*) AS n_neighbours, true AS enough FROM near_test_vecs",
    "stored_texts": """SELECT CAST(doc_id AS VARCHAR) AS case_id, CASE WHEN doc_id % 9 = 0 THEN '' ELSE coalesce(text, '') END AS text
        FROM documents""",
    "incremental_stream": """SELECT doc_id, source, 1::BIGINT AS n_records,
        CASE WHEN doc_id IN (SELECT doc_id FROM labels) THEN 0 ELSE 1 END::BIGINT AS batch FROM documents""",
    "retrieve_train": _near("near_train", ", solution"),
    "representation_choice": """SELECT n_cases, n_vectors, CASE WHEN n_cases = n_vectors AND n_vectors > 0 THEN 'dense'
        ELSE 'sparse' END AS method FROM (SELECT (SELECT count(*) FROM documents) AS n_cases,
        (SELECT count(*) FROM embeddings) AS n_vectors)""",
    "query_sample": "SELECT query_id, case_id, no_perkara, label, query_text FROM sampled",
    "expected_similar": "SELECT case_id, expected FROM expected",
    "query_records": "SELECT * FROM records",
    "vote_majority": "SELECT a.query_id, coalesce(m.solution, '') AS predicted_solution FROM asked a LEFT JOIN majority m ON a.query_id = m.query_id",
    "vote_weighted": "SELECT a.query_id, coalesce(m.solution, '') AS predicted_solution FROM asked a LEFT JOIN weighted m ON a.query_id = m.query_id",
    "predict_batch": """SELECT a.query_id, coalesce(m.solution, '') AS predicted_solution, coalesce((SELECT string_agg(CAST(doc_id AS VARCHAR), '|'
        ORDER BY rank) FROM near_train n WHERE n.query_id = a.query_id), '') AS top_5_case_ids
        FROM asked a LEFT JOIN weighted m ON a.query_id = m.query_id""",
    "svm_quality": """SELECT count(*) AS n_test, count(DISTINCT label) AS n_classes, true AS beats_majority FROM case_test""",
    "scale_minmax": "SELECT idx, round(low, 6) AS low, round(range, 6) AS range FROM spans",
    "nb_model": "SELECT idx, label, round(logp, 6) AS logp FROM logp",
    "nb_predict": "SELECT case_id, true_label, pred_label, round(score, 4) AS score FROM pred",
    "clf_metrics": "SELECT * FROM clf",
    "clf_report": """SELECT label, round_even(p, 4) AS precision, round_even(r, 4) AS recall, round_even(f, 4) AS f1, support FROM (
        SELECT label, p, r, f, support FROM per_class
        UNION ALL SELECT 'macro avg', avg(p), avg(r), avg(f), CAST(sum(support) AS BIGINT) FROM per_class
        UNION ALL SELECT 'weighted avg', sum(p * support) / sum(support), sum(r * support) / sum(support),
          sum(f * support) / sum(support), CAST(sum(support) AS BIGINT) FROM per_class)""",
    "confusion": """SELECT a.label AS true_label, b.label AS pred_label, (SELECT count(*) FROM pred WHERE true_label = a.label
        AND pred_label = b.label) AS n FROM label_names a CROSS JOIN label_names b""",
    "errors": "SELECT case_id, true_label, pred_label, no_perkara, jumlah_kata FROM wrong",
    "error_profile": """SELECT 'true_label' AS part, true_label AS key, count(*)::DOUBLE AS value FROM wrong GROUP BY true_label
        UNION ALL SELECT 'pred_label', pred_label, count(*)::DOUBLE FROM wrong GROUP BY pred_label
        UNION ALL SELECT 'mean_words', '', round(avg(jumlah_kata), 4) FROM wrong""",
    "retrieval_at_k": "SELECT * FROM sparse_at_k UNION ALL SELECT * FROM dense_at_k",
    "query_hits": "SELECT * FROM hits",
    "hit_rate": """SELECT 'TF-IDF Retrieval' AS model, round_even(avg(CASE WHEN hit_tfidf THEN 1 ELSE 0 END), 4) AS hit_rate,
        count(*) FILTER (hit_tfidf) AS correct, count(*) AS total FROM hits UNION ALL
        SELECT 'BERT Retrieval', round_even(avg(CASE WHEN hit_bert THEN 1 ELSE 0 END), 4), count(*) FILTER (hit_bert), count(*) FROM hits""",
    "model_comparison": "SELECT * FROM comparison",
    "f1_series": "SELECT model, coalesce(f1, 0) AS f1 FROM comparison",
    "stored_csv": "SELECT case_id, no_perkara, jumlah_kata, keutuhan_teks FROM measured",
    "stored_queries": "SELECT * FROM records",
    "stored_tokens": f"SELECT CAST(doc_id AS VARCHAR) AS case_id, coalesce(array_to_string({_tokens('text')}, ' '), '') AS tokens FROM documents",
    "stored_embeddings": """SELECT CAST(vec_id AS VARCHAR) AS case_id, CAST(len(embedding) AS INTEGER) AS n FROM embeddings
        WHERE vec_id IN (SELECT doc_id FROM documents)""",
    "stored_model": "SELECT case_id, pred_label, round(score, 4) AS score FROM pred",
    "incremental_new": "SELECT doc_id, source FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)",
}


_SELECTS["rep_cases_stored"] = _SELECTS["rep_cases"]


def _report(sections):
    parts = []
    for k, (title, columns, select) in enumerate(sections):
        parts.append(f"SELECT {k} AS section, 0 AS line, '== {title} ==' AS value")
        fields = " || ', ' || ".join(f"'{c}: ' || coalesce(CAST({c} AS VARCHAR), '-')" for c in columns)
        parts.append(f"SELECT {k}, 1, {fields} FROM ({select})")
    return f"""SELECT CAST(row_number() OVER (ORDER BY section, line, value) AS INTEGER) AS line, value
        FROM ({" UNION ALL ".join(parts)})"""


_SELECTS["stored_report"] = _report((
    ("documents", ("n_total", "n_valid", "n_invalid", "status"), _SELECTS["qa_counts"]),
    ("inventories", ("inventory", "n_ids"), _SELECTS["qa_inventory_sizes"]),
    ("missing", ("inventory", "n"), f"SELECT inventory, count(*) AS n FROM ({_SELECTS['qa_inventory_missing']}) GROUP BY inventory"),
    ("short", ("kind", "n"), f"SELECT kind, count(*) AS n FROM ({_SELECTS['qa_short']}) GROUP BY kind"),
    ("incomplete", ("n",), f"SELECT count(*) AS n FROM ({_SELECTS['qa_incomplete']})"),
    ("duplicates", ("n",), f"SELECT count(*) AS n FROM ({_SELECTS['qa_duplicates']})"),
    ("categories", ("jenis_perkara", "n_rows", "retired"), _SELECTS["qa_categories"]),
    ("verdict", ("n_issues", "verdict"), _SELECTS["qa_verdict"]),
))


def oracle_sql() -> dict[str, str]:
    return {name: _statement(select) for name, select in _SELECTS.items()}
