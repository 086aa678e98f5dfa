"""One query for each operator over its whole table, and SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortline.llm import (
    dac, decontam, exact, knlm, langid, packing, periodic, quality, ranked, simhash, substring,
    token_scan, warc)

TOKENIZER = "word_bpe_49k.json"
END_ID = 2
#: The tokenizer's own end of text, which no text can contain when its sign is read as text.
SEPARATOR_ID = 49407


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def remainder(by: int) -> Column:
    """crc32 of the id as text, modulo ``by``; an id that is null counts as empty text."""
    return F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))) % by


def op1_language_id(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    model = langid.fit(docs.filter(remainder(5) != 0))
    return langid.with_language(docs.select("doc_id", "text"), model).select(
        "doc_id", (remainder(5) == 0).alias("held_out"), "lang_pred", "score")


def op2_substring_dedup(spark: SparkSession, folder: str) -> DataFrame:
    found = substring.remove_repeats(table(spark, folder, "documents"))
    return found.select(
        "doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


def op3_token_files(spark: SparkSession, folder: str) -> DataFrame:
    manifest = dac.write_tokens(
        table(spark, folder, "documents"), public_tokenizers.path(TOKENIZER), END_ID)
    return dac.read_documents(manifest)


def op4_packing(spark: SparkSession, folder: str) -> DataFrame:
    return packing.pack(packing.word_lengths(table(spark, folder, "documents")))


def op5_simhash(spark: SparkSession, folder: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, folder, "documents"))
    return found.select(
        "doc_id", F.lower(F.lpad(F.hex("fingerprint"), 16, "0")).alias("fingerprint"),
        "component_id")


def op6_exact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return exact.mark_duplicates(table(spark, folder, "documents")).select(*exact.RESULT)


def op7_quality(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    labels = table(spark, folder, "labels").filter(remainder(3) != 1)
    model = quality.fit(docs, labels)
    return quality.with_quality(docs, model).select(
        "doc_id", (remainder(3) == 1).alias("held_out"), "score",
        F.when(F.col("score") >= 0.5, 1).otherwise(0).alias("predicted"))


def op8_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    found = decontam.contamination(
        table(spark, folder, "documents"), table(spark, folder, "benchmark"))
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"))


def op9_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    files, names = token_scan.write_flat(
        table(spark, folder, "documents"), public_tokenizers.path(TOKENIZER), SEPARATOR_ID)
    counts = token_scan.count_tokens(files, SEPARATOR_ID)
    return counts.join(names, ["part", "turn", "ordinal"]).select(
        "doc_id", "document", "start", "n_tokens")


def op10_lm_scores(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    model = knlm.fit(docs.filter(remainder(5) != 1))
    return knlm.with_scores(docs, model).select(
        "doc_id", (remainder(5) == 1).alias("held_out"), "n_tokens", "n_known",
        F.lit(model.tokens).cast("long").alias("train_tokens"), "base_score", "score", "perplexity")


def with_planted_periods(docs: DataFrame) -> DataFrame:
    """The documents as op11 reads them: one in ten, by its id, repeats its words from a point on."""
    h = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    drawn = docs.select("doc_id", "text", h.alias("h")).withColumn(
        "words", F.when(h % 10 == 0, F.expr(r"regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+', 0)")))
    parts = drawn.withColumn("n", F.size("words").cast("long")).withColumn("g", F.expr("h div 10"))
    placed = parts.withColumn("a", F.when(F.col("n") > 0, F.col("g") % F.col("n"))).withColumn(
        "p", F.expr("1 + (n - a) div (3 + g % 8)"))
    repeated = F.expr(
        "array_join(transform(words, (w, i) -> if(i < a, w, words[cast(a + (i - a) % p AS int)])), ' ')")
    return placed.select("doc_id", F.when(F.col("n") > 0, repeated).otherwise(F.col("text")).alias("text"))


def op11_period_runs(spark: SparkSession, folder: str) -> DataFrame:
    found = periodic.collapse_runs(with_planted_periods(table(spark, folder, "documents")))
    # Least of (-length, start, period): the longest run, ties by start, then period.
    longest = F.array_min(F.transform("runs", lambda r: F.struct(
        (-r.length).alias("less"), r.start.alias("start"), r.period.alias("period"))))
    lines = F.transform("runs", lambda r: F.concat_ws(",", r.start, r.length, r.period))
    return found.withColumn("longest", longest).select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), "longest.start",
        (-F.col("longest.less")).alias("length"), "longest.period",
        F.expr("(-1000 * longest.less) div longest.period").alias("exponent_milli"),
        F.sha2(F.array_join(F.transform(lines, lambda x: F.concat(x, F.lit("\n"))), ""), 256).alias(
            "runs_sha256"),
        F.sha2("kept_text", 256).alias("collapsed_sha256"), "n_words")


def op12_warc(spark: SparkSession, folder: str) -> DataFrame:
    found = warc.read_archives(warc.write_archives(table(spark, folder, "pages")))
    return found.select(
        F.col("page_id").cast("long").alias("page_id"), "payload_bytes", "payload_digest",
        "record_type", F.col("refers_to").cast("long").alias("refers_to"))


def op13_ranked_search(spark: SparkSession, folder: str) -> DataFrame:
    return ranked.search(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (
        op1_language_id, op2_substring_dedup, op3_token_files, op4_packing, op5_simhash,
        op6_exact_dedup, op7_quality, op8_decontamination, op9_token_counts, op10_lm_scores,
        op11_period_runs, op12_warc, op13_ranked_search)
}

_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

SQL: dict[str, str] = {
    "op2_substring_dedup": r"""
        WITH words AS (
            SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w
            FROM documents),
        windows AS (
            SELECT doc_id, i, sha256(array_to_string(w[i:i + 34], ' ')) AS s
            FROM words, unnest(range(1, len(w) - 33)) AS t(i)),
        again AS (SELECT s FROM windows GROUP BY s HAVING count(*) > 1),
        covered AS (
            SELECT DISTINCT doc_id, i + k AS p
            FROM windows JOIN again USING (s), unnest(range(0, 35)) AS r(k)),
        placed AS (SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS p FROM words),
        kept AS (
            SELECT doc_id, string_agg(word, ' ' ORDER BY p) AS t, count(*) AS n
            FROM placed ANTI JOIN covered USING (doc_id, p) GROUP BY doc_id)
        SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words,
               CAST(len(w) - coalesce(n, 0) AS BIGINT) AS n_removed,
               sha256(coalesce(t, '')) AS kept_sha256
        FROM words LEFT JOIN kept USING (doc_id)""",
    "op6_exact_dedup": r"""
        WITH plain AS (
            SELECT doc_id, sha256(regexp_replace(
                coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) AS text_sha256
            FROM documents)
        SELECT doc_id, min(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
               doc_id = min(doc_id) OVER same AS kept, text_sha256
        FROM plain WINDOW same AS (PARTITION BY text_sha256)""",
    "op8_decontamination": rf"""
        WITH docs AS (
            SELECT doc_id, regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
            FROM documents),
        items AS (
            SELECT item_id, regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
            FROM benchmark),
        wanted AS (
            SELECT DISTINCT item_id, least(10, len(w)) AS size,
                   array_to_string(w[i:i + least(10, len(w)) - 1], ' ') AS s
            FROM items, unnest(range(1, greatest(1, len(w) - 9) + 1)) AS t(i) WHERE len(w) > 0),
        sizes AS (SELECT DISTINCT size FROM wanted),
        windows AS (
            SELECT doc_id, i, size, array_to_string(w[i:i + size - 1], ' ') AS s
            FROM docs, sizes, unnest(range(1, len(w) - size + 2)) AS t(i)),
        found AS (SELECT doc_id, i, size, item_id FROM windows JOIN wanted USING (size, s)),
        hits AS (
            SELECT doc_id, count(DISTINCT i + k) AS n
            FROM found, unnest(range(0, size)) AS r(k) GROUP BY doc_id),
        named AS (
            SELECT doc_id, count(*) AS n, string_agg(item, ',' ORDER BY item) AS ids
            FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM found)
            GROUP BY doc_id)
        SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(hits.n, 0) AS n_hit,
               coalesce(named.n, 0) AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
               coalesce(hits.n, 0) > 0 AS contaminated
        FROM docs LEFT JOIN hits USING (doc_id) LEFT JOIN named USING (doc_id)""",
    "op12_warc": """
        WITH payloads AS (
            SELECT page_id, coalesce(html, '') AS body, sha256(coalesce(html, '')) AS digest
            FROM pages),
        firsts AS (
            SELECT *, min(page_id) OVER (PARTITION BY digest) AS lowest,
                   strlen(body) >= 100 AS large FROM payloads)
        SELECT page_id, strlen(body) AS payload_bytes, digest AS payload_digest,
               CASE WHEN large AND page_id > lowest THEN 'revisit' ELSE 'response' END AS record_type,
               CASE WHEN large AND page_id > lowest THEN lowest END AS refers_to
        FROM firsts""",
    "op13_ranked_search": rf"""
        WITH terms AS (
            SELECT doc_id, row_number() OVER () AS r, regexp_extract_all(
                {_LOWER}, '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS w FROM documents),
        held AS (SELECT r, unnest(w) AS term FROM terms),
        postings AS (SELECT r, term, count(*) AS tf FROM held GROUP BY r, term),
        totals AS (SELECT count(*) FILTER (len(w) > 0) AS n_docs, sum(len(w))::BIGINT AS n_terms FROM terms),
        weights AS (
            SELECT term, CAST(floor(1000 * ln((2 * any_value(n_docs) + 2) / (2 * count(*) + 1))) AS BIGINT) AS weight
            FROM postings, totals GROUP BY term),
        asked AS (
            SELECT DISTINCT item_id, unnest(regexp_extract_all(
                {_LOWER}, '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark),
        scores AS (
            SELECT item_id, doc_id, sum(weight * ((1000000000 * tf)
                       // (1000 * tf + 8 * (10 + (90 * len(w) * n_docs) // n_terms))))::BIGINT AS score
            FROM asked JOIN weights USING (term) JOIN postings USING (term) JOIN terms USING (r), totals
            GROUP BY item_id, r, doc_id),
        ranked AS (
            SELECT item_id, CAST(row_number() OVER (
                PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank, doc_id, score
            FROM scores WHERE score > 0)
        SELECT * FROM ranked WHERE rank <= 10""",
}
