"""The registered queries of the subpackage and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidebook.llm import base, conversations, decontaminate, html_text, line_dedup, ngram_join, packing, phrases, quality, seed_extend, simhash, spotsigs, suffix_repeats, warc


def op1_spotsigs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Spot-signature fingerprints of every text and of the text edited with the next one."""
    return spotsigs.against_next(base.table(spark, sf_dir, "documents"))


def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of 40 characters and more in five or more documents stay only where the id is largest.

    The index takes the documents in two goes, the second through the filters of the first.
    """
    docs = base.table(spark, sf_dir, "documents").select("doc_id", "text")
    second = base.spread("doc_id") % 2 == 1
    kept = line_dedup.drop_lines(docs, line_dedup.LineIndex.build(docs.filter(~second)).insert(docs.filter(second)))
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2(F.col("text").cast("binary"), 256).alias("kept_sha256"))


def op3_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Weak-label posterior, quality score and toxicity of every document, and whether it stays."""
    docs, labels = (base.table(spark, sf_dir, name) for name in ("documents", "labels"))
    judged = quality.scores(docs.select("doc_id", "text"), quality.fit(docs, labels))
    return judged.select("doc_id", "votes", "posterior", "score", "toxicity", "keep")


def op4_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page written to WARC archives, found through the capture index and read back."""
    pages = base.table(spark, sf_dir, "pages")
    archive = warc.write_archive(pages)
    records = archive.read(archive.find(warc.page_keys(pages)))
    return records.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op5_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of documents whose sets of four-word shingles have a Jaccard similarity of 0.85 and more."""
    return ngram_join.groups(base.table(spark, sf_dir, "documents")).select("doc_id", "n_shingles", "component_id")


def op6_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of every document that occur in windows of 13 words of benchmark items."""
    docs, benchmark = (base.table(spark, sf_dir, name) for name in ("documents", "benchmark"))
    judged = decontaminate.judge(decontaminate.find(docs, benchmark))
    return judged.select("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")


def op7_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents without the words of 20-word windows that start earlier."""
    kept = seed_extend.remove(base.table(spark, sf_dir, "documents"))
    return kept.select("doc_id", "n_words", "n_removed", "kept_sha256")


def op8_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The main text of every page."""
    return html_text.main_text(base.table(spark, sf_dir, "pages"))


def op9_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents without the bytes of strings of 400 bytes that occur elsewhere too."""
    kept = suffix_repeats.remove(base.table(spark, sf_dir, "documents"))
    return kept.select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")


def op10_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's pieces with their places in sequences of 1024 tokens."""
    return packing.pack(base.table(spark, sf_dir, "documents"))


def op11_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first 2,000 phrases of two and three words of every language, by their weakest cut."""
    return phrases.collocations(base.table(spark, sf_dir, "documents"))


def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Faults of every damaged conversation and the cheapest edits that make its roles alternate again."""
    return conversations.repair(base.table(spark, sf_dir, "conversations"))


def op13_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SimHash of three-word shingles and the classes of documents whose fingerprints differ in at most two bits."""
    return simhash.groups(base.table(spark, sf_dir, "documents")).select("doc_id", "fingerprint", "component_id")


QUERIES = {
    "op1_spotsigs": op1_spotsigs,
    "op2_line_dedup": op2_line_dedup,
    "op3_quality_classifier": op3_quality_classifier,
    "op4_warc": op4_warc,
    "op5_ngram_join": op5_ngram_join,
    "op6_decontamination": op6_decontamination,
    "op7_substring_dedup": op7_substring_dedup,
    "op8_html_extraction": op8_html_extraction,
    "op9_suffix_array_dedup": op9_suffix_array_dedup,
    "op10_best_fit_packing": op10_best_fit_packing,
    "op11_phrases": op11_phrases,
    "op12_conversation_repair": op12_conversation_repair,
    "op13_simhash": op13_simhash,
}

ORACLE = {
    "op4_warc": """
        WITH facts AS (
            SELECT page_id, url, strlen(coalesce(html, '')) AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest
            FROM pages),
        firsts AS (
            SELECT payload_digest AS digest, min(page_id) AS original FROM facts WHERE payload_bytes >= 100 GROUP BY 1)
        SELECT page_id, payload_bytes, payload_digest,
            CASE WHEN original IS NULL OR original = page_id THEN 'response' ELSE 'revisit' END AS record_type,
            CASE WHEN original <> page_id THEN original END AS refers_to
        FROM facts LEFT JOIN firsts ON payload_digest = digest
    """,
    "op2_line_dedup": r"""
        WITH docs AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents),
        cut AS (SELECT doc_id, unnest(lines) AS line, unnest(range(len(lines))) AS place FROM docs),
        stripped AS (
            SELECT doc_id, place, line,
                translate(regexp_replace(line, '^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$', '', 'g'),
                    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
            FROM cut),
        repeated AS (
            SELECT key, max(doc_id) AS keeper FROM stripped WHERE length(key) >= 40
            GROUP BY key HAVING count(DISTINCT doc_id) >= 5),
        judged AS (
            SELECT s.doc_id, s.place, s.line, r.key IS NOT NULL AND s.doc_id <> r.keeper AS dropped
            FROM stripped s LEFT JOIN repeated r ON s.key = r.key)
        SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE dropped) AS n_dropped,
            sha256(coalesce(string_agg(line, chr(10) ORDER BY place) FILTER (WHERE NOT dropped), '')) AS kept_sha256
        FROM judged GROUP BY doc_id
    """,
    "op6_decontamination": r"""
        WITH lowered AS (
            SELECT 'd' AS kind, doc_id AS id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text FROM documents
            UNION ALL
            SELECT 'b', item_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') FROM benchmark),
        split AS (SELECT kind, id, regexp_extract_all(text, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM lowered),
        docs AS (SELECT id AS doc_id, w FROM split WHERE kind = 'd'),
        items AS (
            SELECT DISTINCT id AS item_id, least(len(w), 13) AS size, array_to_string(w[s:s + 12], ' ') AS phrase
            FROM (SELECT id, w, unnest(range(1, greatest(len(w) - 12, 1) + 1)) AS s FROM split WHERE kind = 'b' AND len(w) > 0)),
        phrases AS (SELECT DISTINCT size, phrase FROM items),
        windows AS (
            SELECT doc_id, size, s, array_to_string(w[s:s + size - 1], ' ') AS phrase
            FROM (SELECT doc_id, w, size, unnest(range(1, len(w) - size + 2)) AS s
                  FROM docs CROSS JOIN (SELECT DISTINCT size FROM phrases) WHERE len(w) >= size)),
        hits AS (SELECT doc_id, s, size, phrase FROM windows JOIN phrases USING (size, phrase)),
        covered AS (SELECT doc_id, count(DISTINCT i) AS n FROM (SELECT doc_id, unnest(range(s, s + size)) AS i FROM hits) GROUP BY doc_id),
        named AS (
            SELECT doc_id, count(*) AS n, string_agg(name, ',' ORDER BY name) AS names
            FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS name FROM hits JOIN items USING (size, phrase)) GROUP BY doc_id)
        SELECT doc_id, len(w) AS n_words, coalesce(covered.n, 0) AS n_hit, coalesce(named.n, 0) AS n_items,
            sha256(coalesce(names, '')) AS items_sha256, coalesce(covered.n, 0) > 0 AND 20 * coalesce(covered.n, 0) >= len(w) AS contaminated
        FROM docs LEFT JOIN covered USING (doc_id) LEFT JOIN named USING (doc_id)
    """,
    "op7_substring_dedup": r"""
        WITH docs AS (
            SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
        windows AS (
            SELECT doc_id, s, md5(array_to_string(w[s:s + 19], ' ')) AS words
            FROM (SELECT doc_id, w, unnest(range(1, len(w) - 18)) AS s FROM docs WHERE len(w) >= 20)),
        again AS (
            SELECT doc_id, s FROM (SELECT *, row_number() OVER (PARTITION BY words ORDER BY doc_id, s) AS n FROM windows) WHERE n > 1),
        gone AS (SELECT DISTINCT doc_id, unnest(range(s, s + 20)) AS i FROM again),
        words AS (SELECT doc_id, unnest(range(1, len(w) + 1)) AS i, unnest(w) AS word FROM docs),
        rest AS (
            SELECT words.doc_id, count(gone.i) AS n_removed, string_agg(word, ' ' ORDER BY words.i) FILTER (gone.i IS NULL) AS text
            FROM words LEFT JOIN gone ON words.doc_id = gone.doc_id AND words.i = gone.i GROUP BY words.doc_id)
        SELECT doc_id, len(w) AS n_words, coalesce(n_removed, 0) AS n_removed, sha256(coalesce(rest.text, '')) AS kept_sha256
        FROM docs LEFT JOIN rest USING (doc_id)
    """,
    "op11_phrases": r"""
        WITH cut AS (
            SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(
                translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
            FROM documents),
        pieces AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM cut),
        sizes AS (SELECT lang, CAST(sum(len(w)) AS BIGINT) AS n FROM pieces GROUP BY lang),
        grams AS (
            SELECT lang, 1 AS size, unnest(w) AS phrase FROM pieces
            UNION ALL SELECT lang, 2, unnest(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) FROM pieces
            UNION ALL SELECT lang, 3, unnest(list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2])) FROM pieces),
        f AS (SELECT lang, size, phrase, count(*) AS n FROM grams GROUP BY ALL),
        often AS (SELECT lang, size, phrase, n AS a, string_split(phrase, ' ') AS w FROM f WHERE size > 1 AND n >= 10),
        larger AS (
            SELECT lang, inner_phrase AS phrase, max(a) AS most
            FROM (SELECT lang, a, unnest([w[1] || ' ' || w[2], w[2] || ' ' || w[3]]) AS inner_phrase FROM often WHERE size = 3) GROUP BY ALL),
        parts AS (
            SELECT *, array_to_string(w[1:k], ' ') AS head, array_to_string(w[k + 1:], ' ') AS tail
            FROM (SELECT *, unnest(range(1, size)) AS k FROM often)),
        scored AS (
            SELECT p.lang, p.phrase, p.a, p.k, h.n AS l, t.n AS r,
                CAST(1000000::HUGEINT * p.a * p.a // (h.n::HUGEINT * t.n) AS BIGINT) AS score
            FROM parts p JOIN f h ON h.lang = p.lang AND h.phrase = p.head AND h.size = p.k
            JOIN f t ON t.lang = p.lang AND t.phrase = p.tail AND t.size = p.size - p.k),
        weakest AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
        ranked AS (
            SELECT weakest.*, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank
            FROM weakest LEFT JOIN larger USING (lang, phrase) WHERE most IS NULL OR 100 * most < 50 * a)
        SELECT lang, rank, phrase, a, l, r, n, score FROM ranked JOIN sizes USING (lang) WHERE rank <= 2000
    """,
}
