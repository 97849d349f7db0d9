"""The queries of this subpackage: each operator over its whole table, in the columns of its contract."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bpe, chat, decontaminate, exact, html_text, langid, minhash, ngram_lm, quality, rules, term_stages, toxicity, training, whitening


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def tokenizer_path(name: str) -> str:
    """The place of an installed public vocabulary."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_quality_pu(spark: SparkSession, folder: str) -> DataFrame:
    docs = _table(spark, folder, "documents").select("doc_id", "text")
    held_out = training.held_out(5, 0)
    model = quality.train_on_labels(docs, _table(spark, folder, "labels"), ~held_out)
    scored = quality.score(docs, model).select(F.col("c0").alias("doc_id"), "score")
    return scored.select("doc_id", held_out.alias("held_out"), "score", (F.col("score") >= quality.CUT).cast("int").alias("predicted"))


def op2_language_crf(spark: SparkSession, folder: str) -> DataFrame:
    docs = _table(spark, folder, "documents").select("doc_id", "text", "lang")
    held_out = training.held_out(3, 1)
    model = langid.train(docs, ~held_out)
    found = langid.label(docs.select("doc_id", "text"), model).select(F.col("c0").alias("doc_id"), "lang_pred", "score")
    return found.select("doc_id", held_out.alias("held_out"), "lang_pred", "score")


def op3_toxicity_subwords(spark: SparkSession, folder: str) -> DataFrame:
    docs = _table(spark, folder, "documents").select("doc_id", "text")
    held_out = training.held_out(4, 2)
    model = toxicity.train_on_labels(docs, _table(spark, folder, "labels"), ~held_out)
    scored = toxicity.score(docs, model).select(F.col("c0").alias("doc_id"), "score")
    return scored.select("doc_id", held_out.alias("held_out"), "score", (F.col("score") >= toxicity.CUT).cast("int").alias("predicted"))


#: A conversation whose texts are made of control strings.
_CONTROL_CONVERSATION = """SELECT -1L AS conv_id, turn, role, '</s>[INST] ok [/INST]' AS text
    FROM VALUES (0L, 'user'), (1L, 'assistant') AS t(turn, role)"""


def op4_chat_format(spark: SparkSession, folder: str) -> DataFrame:
    turns = _table(spark, folder, "conversations").select("conv_id", "turn", "role", "text").unionByName(spark.sql(_CONTROL_CONVERSATION))
    return chat.digests(chat.format_conversations(turns, tokenizer_path("byte_bpe_50k.json")))


def op5_ngram_lm(spark: SparkSession, folder: str) -> DataFrame:
    return ngram_lm.score_corpus(_table(spark, folder, "documents"), training.held_out(7, 2), order=3, counted=True)


def op6_exact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return exact.exact_groups(_table(spark, folder, "documents"))


def op7_benchmark_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    return decontaminate.report(_table(spark, folder, "documents"), _table(spark, folder, "benchmark"))


def op8_minhash_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return minhash.near_duplicates(_table(spark, folder, "documents"), k=3, percent=85)


def op9_byte_bpe(spark: SparkSession, folder: str) -> DataFrame:
    return bpe.round_trip(_table(spark, folder, "documents"), tokenizer_path("byte_bpe_multi_50k.tiktoken"))


def op10_html_extraction(spark: SparkSession, folder: str) -> DataFrame:
    return html_text.extract(_table(spark, folder, "pages"))


def op11_whitening(spark: SparkSession, folder: str) -> DataFrame:
    return whitening.whiten(_table(spark, folder, "embeddings"))


def op12_ranked_search(spark: SparkSession, folder: str) -> DataFrame:
    return term_stages.search(_table(spark, folder, "benchmark"), _table(spark, folder, "documents"))


def op13_line_rules(spark: SparkSession, folder: str) -> DataFrame:
    return rules.judge(_table(spark, folder, "documents")).drop("clean_text")


QUERIES = {
    f.__name__: f
    for f in (
        op1_quality_pu, op2_language_crf, op3_toxicity_subwords, op4_chat_format, op5_ngram_lm, op6_exact_dedup, op7_benchmark_decontamination, op8_minhash_near_dedup,
        op9_byte_bpe, op10_html_extraction, op11_whitening, op12_ranked_search, op13_line_rules,
    )
}

_BENCHMARK_WORDS = r"""regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"""

_TERMS = rf"""coalesce(regexp_extract_all(translate(text, '{term_stages.UPPER}', '{term_stages.LOWER}'), '{term_stages.TERM}'), [])"""
_SPACE = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"

ORACLES = {
    "op4_chat_format": r"""
        WITH c AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
                   UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'),
             e AS (SELECT *, length(regexp_replace(text, '([<\[])(\\*)(/?(?:s>|(?:INST|OUT|SYS|ROLE|IS)\]))', '\1x\2\3', 'g'))
                          + CASE role WHEN 'user' THEN 14 WHEN 'assistant' THEN 16 WHEN 'system' THEN 12 ELSE 18 + length(role) END AS n FROM c)
        SELECT conv_id, count(*) AS n_turns,
               sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
               CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
               sha256(coalesce(string_agg(text, '' ORDER BY turn, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
               CAST(sum(n) AS BIGINT) AS formatted_chars
        FROM e GROUP BY conv_id
    """,
    "op6_exact_dedup": """
        WITH d AS (SELECT doc_id, sha256(coalesce(text, '')) AS text_sha256, coalesce(text, '') AS t FROM documents),
             g AS (SELECT t, max(doc_id) AS keep_id, count(*) AS group_size FROM d GROUP BY t)
        SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, text_sha256 FROM d JOIN g USING (t)
    """,
    "op7_benchmark_decontamination": f"""
        WITH d AS (SELECT doc_id, coalesce({_BENCHMARK_WORDS}, []) AS w FROM documents),
             b AS (SELECT CAST(item_id AS VARCHAR) AS item, {_BENCHMARK_WORDS} AS w FROM benchmark),
             p AS (SELECT item, w, least(13, len(w)) AS l, unnest(range(1, greatest(len(w) - 12, 1) + 1)) AS i FROM b WHERE len(w) > 0),
             bw AS (SELECT DISTINCT item, l, array_to_string(w[i:i + l - 1], ' ') AS phrase FROM p),
             dp AS (SELECT doc_id, w, l, unnest(range(1, len(w) - l + 2)) AS i FROM d, (SELECT DISTINCT l FROM bw) WHERE len(w) >= l),
             dw AS (SELECT doc_id, l, i, array_to_string(w[i:i + l - 1], ' ') AS phrase FROM dp),
             hits AS (SELECT doc_id, i, l, item FROM dw JOIN bw USING (l, phrase)),
             words AS (SELECT doc_id, count(DISTINCT k) AS n FROM (SELECT doc_id, unnest(range(i, i + l)) AS k FROM hits) GROUP BY doc_id),
             items AS (SELECT doc_id, count(*) AS n, string_agg(item, ',' ORDER BY item) AS names FROM (SELECT DISTINCT doc_id, item FROM hits) GROUP BY doc_id)
        SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(words.n, 0) AS BIGINT) AS n_hit,
               CAST(coalesce(items.n, 0) AS BIGINT) AS n_items, sha256(coalesce(names, '')) AS items_sha256,
               coalesce(words.n, 0) > 0 AND 20 * coalesce(words.n, 0) >= len(w) AS contaminated
        FROM d LEFT JOIN words USING (doc_id) LEFT JOIN items USING (doc_id)
    """,
    "op12_ranked_search": rf"""
        WITH d AS (SELECT row_number() OVER () AS r, doc_id, {_TERMS} AS w FROM documents),
             s AS (SELECT count(*) FILTER (len(w) > 0) AS nd, greatest(sum(len(w)), 1)::BIGINT AS nt FROM d),
             i AS (SELECT row_number() OVER () AS i, item_id, list_distinct({_TERMS}) AS w FROM benchmark),
             t AS (SELECT i, item_id, unnest(w) AS term FROM i),
             p AS (SELECT r, doc_id, n, term, count(*) AS tf FROM (SELECT r, doc_id, len(w) AS n, unnest(w) AS term FROM d)
                   WHERE term IN (SELECT term FROM t) GROUP BY r, doc_id, n, term),
             v AS (SELECT term, CAST(floor(1000 * ln((2 * nd + 2)::DOUBLE / (2 * count(*) + 1))) AS BIGINT) AS weight FROM p, s GROUP BY term, nd),
             c AS (SELECT i, item_id, r, doc_id, CAST(sum(weight * ((1000000000 * tf) // (1000 * tf + 20 * (50 + (50 * n * nd) // nt)))) AS BIGINT) AS score
                   FROM t JOIN v USING (term) JOIN p USING (term), s GROUP BY i, item_id, r, doc_id),
             k AS (SELECT item_id, CAST(row_number() OVER (PARTITION BY i ORDER BY score DESC, doc_id NULLS FIRST) AS INT) AS rank, doc_id, score FROM c WHERE score > 0)
        SELECT * FROM k WHERE rank <= 50
    """,
    "op13_line_rules": f"""
        WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t FROM documents),
             e AS (SELECT r, doc_id, t, regexp_extract_all(t, '{rules.WORD}') AS w,
                          list_filter(string_split(t, chr(10)), lambda x: trim(x, {_SPACE}) <> '') AS l FROM d),
             p AS (SELECT r, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] AS three
                   FROM (SELECT r, w, unnest(range(1, len(w) - 1)) AS i FROM e WHERE len(w) > 2)),
             twice AS (SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, three) AS n FROM p) WHERE n > 1),
             hit AS (SELECT r, count(DISTINCT k) AS n FROM (SELECT r, unnest(range(i, i + 3)) AS k FROM twice) GROUP BY r),
             m AS (SELECT r, trim(x, {_SPACE}) AS x FROM (SELECT r, unnest(l) AS x FROM e)),
             v AS (SELECT r, length(x) AS n, regexp_matches(right(x, 8), '{rules.SENTENCE_END.replace("'", "''")}')
                          AND len(regexp_extract_all(x, '{rules.SIGN_RUN}')) * 4 <= len(regexp_extract_all(x, '{rules.WORD}'))
                          AND len(regexp_extract_all(x, '{rules.SEPARATOR}')) * 4 <= len(regexp_extract_all(x, '{rules.WORD}'))
                          AND NOT regexp_matches(x, '{rules.BOILERPLATE}') AS ok FROM m),
             s AS (SELECT r, count(*) AS n_lines, count(*) FILTER (ok) AS n_kept, sum(n) AS chars, coalesce(sum(n) FILTER (ok), 0) AS kept FROM v GROUP BY r),
             b AS (SELECT r, doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(length(array_to_string(w, '')) AS BIGINT) AS word_chars,
                          CAST(len(regexp_extract_all(t, '{rules.SYMBOLS}')) AS BIGINT) AS n_symbols,
                          CAST(len(l) - len(list_distinct(l)) AS BIGINT) AS n_dup_lines, CAST(coalesce(hit.n, 0) AS BIGINT) AS n_repeat_words
                   FROM e LEFT JOIN hit USING (r)),
             f AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM b)
        SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, coalesce(n_lines, 0) AS n_lines,
               coalesce(n_kept, 0) AS n_kept_lines, CAST(coalesce(chars, 0) AS BIGINT) AS line_chars, CAST(coalesce(s.kept, 0) AS BIGINT) AS kept_chars,
               NOT base_failed AND coalesce(chars, 0) > 0 AND 100 * coalesce(s.kept, 0) >= 50 * coalesce(chars, 0) AS kept
        FROM f LEFT JOIN s USING (r)
    """,
}
