"""The operators as queries over the given tables, and SQL for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from remitlake.llm import byte_bpe, chat_format, decontaminate, divergence, exact_dedup, language_model, lexical_search, pii, quality, similarity_join, substring_dedup, token_counts, warc

BYTE_BPE = public_tokenizers.path("byte_bpe_50k.tiktoken")
BYTE_PATTERN = public_tokenizers.PATTERN


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.score_quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op2_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return similarity_join.near_duplicates(table(spark, sf_dir, "documents"))


def op3_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_dedup(table(spark, sf_dir, "documents"))


def op4_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.token_counts(table(spark, sf_dir, "documents"), BYTE_BPE)


def op5_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.digests(substring_dedup.drop_repeats(table(spark, sf_dir, "documents")))


def op6_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_model.score(table(spark, sf_dir, "documents"))


def op7_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.archive_pages(table(spark, sf_dir, "pages"))


def op8_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.summary(pii.find_personal_data(table(spark, sf_dir, "documents")))


def op9_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    hits = decontaminate.benchmark_hits(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return hits.select("doc_id", "contaminated", F.transform("items", lambda x: x["item_id"]).alias("item_ids"), F.array_max(F.transform("items", lambda x: x["similarity"])).alias("similarity"))


def op10_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    encoded = byte_bpe.encode(table(spark, sf_dir, "documents"), BYTE_BPE, BYTE_PATTERN)
    return byte_bpe.digests(byte_bpe.decode(encoded, BYTE_BPE))


def op11_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical_search.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op12_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.audit(table(spark, sf_dir, "documents"))


def op13_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = chat_format.with_added(table(spark, sf_dir, "conversations"))
    return chat_format.digests(chat_format.format_conversations(rows))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {f.__name__: f for f in (op1_quality_classifier, op2_ngram_jaccard_join, op3_exact_dedup, op4_token_counts, op5_substring_dedup, op6_lm_scoring, op7_warc, op8_pii, op9_decontamination, op10_byte_bpe, op11_lexical_search, op12_source_divergence, op13_chat_format)}

_NORMAL = r"regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')"

_LOWER = "translate(coalesce({}, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def _terms(column: str, others: str) -> str:
    return f"regexp_extract_all({_LOWER.format(column)}, '[^{others}\\x5B-\\x60\\x7B-\\x7F]+')"


def _share(n: str, total: str) -> str:
    return f"(1 + (1000000000::HUGEINT * ({n} + 2)) // ({total} + 2 * v))"


def _apart(p: str, q: str) -> str:
    return f"(({p} - {q}) * ({p} - {q})) // ({p} + {q})"


_ESCAPE = r"regexp_replace({}, '([<\[])(\\*)(<SYS>>|</SYS>>|INST\]|/INST\]|s>|/s>|<ROLE>>|</ROLE>>|</TURN>>)', '\1\\\2\3', 'g')"

SQL: dict[str, str] = {
    "op3_exact_dedup": f"""
        WITH own AS (SELECT doc_id, sha256({_NORMAL}) AS text_sha256 FROM documents)
        SELECT doc_id, min(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
               doc_id = min(doc_id) OVER same AS kept, text_sha256
        FROM own WINDOW same AS (PARTITION BY text_sha256)
    """,
    "op2_ngram_jaccard_join": r"""
        WITH RECURSIVE own AS (
            SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents
        ), grams AS (
            SELECT DISTINCT r, array_to_string(w[p : p + 4], ' ') AS g
            FROM (SELECT r, w, unnest(range(1, greatest(2, len(w) - 3))) AS p FROM own WHERE len(w) > 0)
        ), size AS (SELECT r, count(*) AS n FROM grams GROUP BY r),
        common AS (SELECT a.r AS a, b.r AS b, count(*) AS n FROM grams a JOIN grams b ON a.g = b.g AND a.r <> b.r GROUP BY ALL),
        links AS (
            SELECT a, b FROM common JOIN size x ON x.r = a JOIN size y ON y.r = b WHERE 9 * common.n >= 4 * (x.n + y.n)
        ), reached AS (
            SELECT a AS r, a AS other FROM links UNION SELECT reached.r, links.b FROM reached JOIN links ON links.a = reached.other
        ), named AS (SELECT reached.r, min(own.doc_id) AS class_id FROM reached JOIN own ON own.r = other GROUP BY reached.r),
        counted AS (SELECT a AS r, count(*) AS n_links FROM links GROUP BY a)
        SELECT doc_id, coalesce(class_id, doc_id) AS class_id, coalesce(n_links, 0) AS n_links
        FROM own LEFT JOIN named USING (r) LEFT JOIN counted USING (r)
    """,
    "op5_substring_dedup": r"""
        WITH own AS (
            SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents
        ), windows AS (
            SELECT r, doc_id, p, array_to_string(w[p : p + 49], ' ') AS s
            FROM (SELECT r, doc_id, w, unnest(range(1, len(w) - 48)) AS p FROM own WHERE len(w) >= 50)
        ), earliest AS (SELECT s, min(doc_id) AS low FROM windows GROUP BY s),
        hits AS (SELECT r, p FROM windows JOIN earliest USING (s) WHERE doc_id > low),
        words AS (SELECT r, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS i FROM own),
        judged AS (
            SELECT words.r, i, word, coalesce(i - p < 50, false) AS gone
            FROM words ASOF LEFT JOIN hits ON words.r = hits.r AND words.i >= hits.p
        ), told AS (
            SELECT r, count(*) AS n_words, count(*) FILTER (gone) AS n_removed,
                   string_agg(word, ' ' ORDER BY i) FILTER (NOT gone) AS kept
            FROM judged GROUP BY r
        )
        SELECT doc_id, coalesce(n_words, 0) AS n_words, coalesce(n_removed, 0) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
        FROM own LEFT JOIN told USING (r)
    """,
    "op7_warc": """
        WITH own AS (
            SELECT page_id, octet_length(encode(coalesce(html, ''))) AS payload_bytes,
                   sha256(coalesce(html, '')) AS payload_digest FROM pages
        ), met AS (SELECT *, min(page_id) OVER (PARTITION BY payload_digest) AS target FROM own)
        SELECT page_id, payload_bytes, payload_digest,
               CASE WHEN payload_bytes >= 100 AND target <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
               CASE WHEN payload_bytes >= 100 AND target <> page_id THEN target END AS refers_to
        FROM met
    """,
    "op11_lexical_search": rf"""
        WITH own AS (SELECT row_number() OVER () AS r, doc_id, {_terms("text", "\x00-\x2F\x3A-\x40")} AS t FROM documents),
        words AS (SELECT r, unnest(t) AS term FROM own),
        tf AS (SELECT r, term, count(*) AS tf FROM words GROUP BY ALL),
        size AS (SELECT r, count(*) AS n FROM words GROUP BY r),
        total AS (SELECT count(*) AS n_docs, coalesce(sum(n), 0)::BIGINT AS n_terms FROM size),
        weight AS (
            SELECT term, floor(1000 * ln((2 * any_value(n_docs) + 2)::DOUBLE / (2 * count(*) + 1)))::BIGINT AS w
            FROM tf, total GROUP BY term
        ), norm AS (SELECT r, 25 + (75 * n * n_docs) // n_terms AS m FROM size, total),
        asked AS (
            SELECT item_id, term, count(*) AS times
            FROM (SELECT item_id, unnest({_terms("text", "\x00-\x2F\x3A-\x40")}) AS term FROM benchmark) GROUP BY ALL
        ), scored AS (
            SELECT item_id, r, sum(times * w * ((1000000000 * tf) // (1000 * tf + 8 * m)))::BIGINT AS score
            FROM asked JOIN weight USING (term) JOIN tf USING (term) JOIN norm USING (r) GROUP BY ALL
        ), ranked AS (
            SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id NULLS LAST)::INTEGER AS rank,
                   doc_id, score
            FROM scored JOIN own USING (r) WHERE score > 0
        ) SELECT * FROM ranked WHERE rank <= 10
    """,
    "op12_source_divergence": rf"""
        WITH own AS (
            SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
                   {_terms("text", "\x00-\x40")} AS t
            FROM documents
        ), words AS (SELECT r, lang, source, unnest(t) AS term FROM own),
        kept AS (SELECT lang, term, count(*) AS all_n FROM words GROUP BY ALL HAVING count(DISTINCT r) >= 10),
        size AS (SELECT lang, count(*) AS v, sum(all_n)::BIGINT AS all_total FROM kept GROUP BY lang),
        groups AS (SELECT DISTINCT lang, source FROM own),
        met AS (SELECT lang, source, term, count(*) AS n FROM words SEMI JOIN kept USING (lang, term) GROUP BY ALL),
        every AS (
            SELECT lang, source, term, coalesce(n, 0) AS n, all_n, v, all_total,
                   sum(coalesce(n, 0)) OVER (PARTITION BY lang, source) AS total
            FROM groups JOIN kept USING (lang) JOIN size USING (lang) LEFT JOIN met USING (lang, source, term)
        ), shares AS (
            SELECT lang, source, term, n, {_share("n", "total")} AS p, {_share("all_n", "all_total")} AS q FROM every
        ), pairs AS (
            SELECT a.lang, a.source, 'pair' AS part, b.source AS item, sum({_apart("a.p", "b.p")})::BIGINT AS value
            FROM shares a JOIN shares b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL
        ), both_parts AS (
            SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(value, 0) AS value
            FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source
            LEFT JOIN pairs ON pairs.lang = a.lang AND pairs.source = a.source AND pairs.item = b.source
            UNION ALL
            SELECT lang, source, 'term', term, ({_apart("p", "q")})::BIGINT FROM shares WHERE n > 0 AND p > q
        ), ranked AS (
            SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item)::INTEGER AS rank FROM both_parts
        ) SELECT * FROM ranked WHERE part = 'pair' OR rank <= 10
    """,
    "op13_chat_format": rf"""
        WITH rows AS (
            SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
            UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'
        ), said AS (
            SELECT conv_id, count(*) AS n_turns, list(role ORDER BY turn NULLS FIRST, role, text) AS roles,
                   string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text) AS turns,
                   coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), '') AS learned,
                   sum(length({_ESCAPE.format("text")}) + CASE role WHEN 'system' THEN 15 WHEN 'user' THEN 13 WHEN 'assistant' THEN 7
                       ELSE 26 + length({_ESCAPE.format("role")}) END)::BIGINT AS formatted_chars
            FROM rows GROUP BY conv_id
        )
        SELECT conv_id, n_turns, sha256(turns) AS turns_sha256, length(learned) AS loss_chars, sha256(learned) AS loss_sha256,
               formatted_chars,
               CASE WHEN roles = ['system', 'user', 'assistant'] THEN 'instruction' WHEN roles = ['user', 'assistant'] THEN 'prompt'
                    WHEN conv_id % 2 <> 0 AND list_has_all(['system', 'user', 'assistant'], roles)
                    THEN 'conversations' ELSE 'messages' END AS layout
        FROM said
    """,
}
