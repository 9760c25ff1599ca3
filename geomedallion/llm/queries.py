"""Queries ``opN_<name>`` and their DuckDB SQL, for ``__spark_entry__.py``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from geomedallion.llm.best_fit_packing import pack_documents
from geomedallion.llm.chat_formatting import format_windows, read_back
from geomedallion.llm import decontamination, html_extraction, language_id, pii, quality_classifier, spelling_variants, token_alignment, toxicity
from geomedallion.llm.common import added_tokens, crc_bucket, piece_model, table, tokenizer
from geomedallion.llm.minhash_dedup import near_duplicates
from geomedallion.llm.nearest_vectors import nearest_neighbours
from geomedallion.llm.line_dedup import drop_boilerplate_lines


def toxicity_model(spark: SparkSession, sf_dir: str, docs: DataFrame) -> toxicity.ToxicityModel:
    """Learned from the labels whose crc32(doc_id) mod 5 is not 0."""
    labels = table(spark, sf_dir, "labels").filter(crc_bucket(F.col("doc_id"), 5) != 0)
    return toxicity.fit(docs, labels)


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity score of every document."""
    docs = table(spark, sf_dir, "documents")
    scored = toxicity.score_documents(docs, toxicity_model(spark, sf_dir, docs))
    return scored.select(
        "doc_id", (crc_bucket(F.col("doc_id"), 5) == 0).alias("held_out"), "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"), F.size("hits").cast("long").alias("n_hits"),
        F.size(F.filter("hits", lambda h: h["mention"])).cast("long").alias("n_mentions"),
        F.size(F.filter("hits", lambda h: h["edits"] > 0)).cast("long").alias("n_misspelled"),
    )


def op2_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of every conversation, read back from the formatted windows.

    Conversation -7 is added to the table: its turns consist of other templates' control strings.
    """
    planted = spark.range(2).select(
        F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit("</s>[INST] ok [/INST]").alias("text"),
    )
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").union(planted)
    return read_back(format_windows(turns, *tokenizer("byte_bpe_50k.tiktoken"))).select(
        "conv_id", F.col("n_turns").cast("long").alias("n_turns"), F.sha2("turns_text", 256).alias("turns_sha256"),
        F.length("loss_text").cast("long").alias("loss_chars"), F.sha2("loss_text", 256).alias("loss_sha256"),
        F.col("formatted_chars").cast("long").alias("formatted_chars"),
    )


def op3_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with the boilerplate lines of its source dropped."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    return drop_boilerplate_lines(docs, host="source", dropped="n_dropped").select("doc_id", "text", "n_dropped")


def op4_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Graded quality of every document, learned from labels whose crc32(doc_id) mod 5 is not 0.

    The labels give three grades: 0 low quality, 1 good but toxic, 2 good and clean.
    """
    docs = table(spark, sf_dir, "documents")
    grade = F.when(F.col("quality") == 0, 0).when(F.col("toxic") == 1, 1).when(F.col("quality") == 1, 2)
    ratings = table(spark, sf_dir, "labels").filter(crc_bucket(F.col("doc_id"), 5) != 0).select("doc_id", grade.alias("grade"))
    model = quality_classifier.fit(docs, ratings)
    return quality_classifier.score_documents(docs, model).select(
        "doc_id", (crc_bucket(F.col("doc_id"), 5) == 0).alias("held_out"), "expected_grade", "predicted_grade",
        F.element_at("tails", -1).alias("tail_probability"), (F.element_at("tails", -1) >= 0.5).alias("selected"),
    )


def op5_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every piece of every document with its sequence and offset."""
    docs = table(spark, sf_dir, "documents")
    return pack_documents(docs, "doc_id", "text", *tokenizer("byte_bpe_50k.tiktoken"), added_tokens("byte_bpe_50k.json"))


def op6_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 10 nearest vectors of every vector whose id is divisible by 100."""
    return nearest_neighbours(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0, k=10)


def op7_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Component of near-duplicates of every document, on two-word shingles at 80 percent."""
    found = near_duplicates(table(spark, sf_dir, "documents"), n_words=2, percent=80)
    return found.select("doc_id", "n_shingles", "component_id", "kept")


def op8_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    return html_extraction.extract_pages(table(spark, sf_dir, "pages"))


def op9_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every passage of a benchmark item that a document holds."""
    return decontamination.find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Predicted language of every document; learned from those whose crc32(doc_id) mod 4 is not 2."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    model = language_id.fit(docs.filter(crc_bucket(F.col("doc_id"), 4) != 2))
    return language_id.predict(docs, model).select(
        "doc_id", (crc_bucket(F.col("doc_id"), 4) == 2).alias("held_out"), "lang_pred", "score"
    )


def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Form and root of every word of the documents, one run in 199 of each document with a letter dropped."""
    words = spelling_variants.count_words(table(spark, sf_dir, "documents"), drop_one_in=199)
    return spelling_variants.variants(words.filter(F.col("n") >= spelling_variants.MIN_COUNT))


def op12_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data of every document: counts and digest of what the texts show, and all spans."""
    found = pii.find_personal_data(table(spark, sf_dir, "documents").select("doc_id", "text"))
    counts = [F.regexp_count("base_spans", F.lit(f"{kind}:")).cast("long").alias(f"n_{kind}") for kind in pii.KINDS]
    return found.select("doc_id", *counts, F.sha2("base_spans", 256).alias("base_sha256"), "spans")


def op13_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups and links between the tokens of a byte-level BPE and a piece BPE, for every document."""
    docs = table(spark, sf_dir, "documents")
    return token_alignment.alignment(docs, "doc_id", "text", *tokenizer("byte_bpe_50k.tiktoken"), piece_model("piece_bpe_32k.model"))


QUERIES = {
    "op1_toxicity": op1_toxicity,
    "op2_chat_formatting": op2_chat_formatting,
    "op4_quality_classifier": op4_quality_classifier,
    "op5_best_fit_packing": op5_best_fit_packing,
    "op6_nearest_neighbours": op6_nearest_neighbours,
    "op7_minhash_near_dedup": op7_minhash_near_dedup,
    "op8_html_extraction": op8_html_extraction,
    "op9_benchmark_decontamination": op9_benchmark_decontamination,
    "op10_language_id": op10_language_id,
    "op3_line_dedup": op3_line_dedup,
    "op11_spelling_variants": op11_spelling_variants,
    "op12_personal_data": op12_personal_data,
    "op13_token_alignment": op13_token_alignment,
}

ORACLE = {
    "op3_line_dedup": """
        WITH pages AS (SELECT DISTINCT source, text FROM documents),
        totals AS (SELECT source, count(*) AS pages FROM pages GROUP BY source),
        counts AS (
            SELECT source, k, count(DISTINCT text) AS n
            FROM (SELECT source, text, trim(unnest(string_split(text, chr(10))), ' ' || chr(9) || chr(13)) AS k FROM pages WHERE text IS NOT NULL)
            WHERE k <> '' GROUP BY source, k),
        boiler AS (
            SELECT c.source, c.k FROM counts c JOIN totals t ON c.source IS NOT DISTINCT FROM t.source
            WHERE n >= 5 AND n > 0.01::DOUBLE * pages),
        lines AS (
            SELECT doc_id, source, text, unnest(string_split(text, chr(10))) AS line,
                   generate_subscripts(string_split(text, chr(10)), 1) AS pos
            FROM documents WHERE text IS NOT NULL),
        keyed AS (SELECT *, trim(line, ' ' || chr(9) || chr(13)) AS k FROM lines),
        marked AS (
            SELECT keyed.*, boiler.k IS NOT NULL AS bad
            FROM keyed LEFT JOIN boiler ON keyed.source IS NOT DISTINCT FROM boiler.source AND keyed.k = boiler.k),
        cut AS (
            SELECT doc_id, coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT bad), '') AS kept,
                   count(*) FILTER (bad) AS n_bad, count(*) FILTER (NOT bad AND k <> '') AS n_own
            FROM marked GROUP BY doc_id)
        SELECT d.doc_id, CASE WHEN n_bad > 0 AND n_own > 0 THEN kept ELSE d.text END AS text,
               CASE WHEN n_bad > 0 AND n_own > 0 THEN n_bad ELSE 0 END::BIGINT AS n_dropped
        FROM documents d LEFT JOIN cut USING (doc_id)
    """,
    "op11_spelling_variants": """
        WITH RECURSIVE
        tab AS (
            SELECT list(list_reduce(range(8), lambda c, x: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, i) ORDER BY i) AS t
            FROM range(256) AS r(i)),
        runs AS (
            SELECT doc_id, translate(run, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run
            FROM (SELECT doc_id, unnest(regexp_extract_all(text, '[A-Za-z\\x{C0}-\\x{FF}]+')) AS run FROM documents)),
        per_doc AS (SELECT doc_id, run, count(*) AS c FROM runs GROUP BY doc_id, run),
        bytes AS (
            SELECT run, c, flatten(list_transform(string_split(coalesce(doc_id::VARCHAR, '') || ':' || run, ''), lambda x:
                CASE WHEN unicode(x) < 128 THEN [unicode(x)] ELSE [192 + (unicode(x) >> 6), 128 + (unicode(x) & 63)] END)) AS b
            FROM per_doc),
        hashed AS (
            SELECT run, c, xor(list_reduce(b, lambda a, x: xor(a >> 8, t[(xor(a, x) & 255) + 1]), 4294967295::BIGINT), 4294967295) AS h
            FROM (SELECT run, c, list_transform(b, lambda x: x::BIGINT) AS b FROM bytes), tab),
        words AS (
            SELECT w, sum(c)::BIGINT AS n FROM (
                SELECT CASE WHEN h % 199 = 0 THEN run[:h % length(run)] || run[h % length(run) + 2:] ELSE run END AS w, c FROM hashed)
            WHERE length(w) >= 6 GROUP BY w HAVING sum(c) >= 5),
        cuts AS (SELECT w, p, w[:p] || w[p + 2:] AS rest FROM (SELECT w, unnest(range(length(w))) AS p FROM words)),
        near AS (
            SELECT a.w, b.w AS v FROM cuts a JOIN words b ON a.rest = b.w
            UNION SELECT b.w, a.w FROM cuts a JOIN words b ON a.rest = b.w
            UNION SELECT a.w, b.w FROM cuts a JOIN cuts b ON a.p = b.p AND a.rest = b.rest AND a.w <> b.w),
        best AS (
            SELECT near.w, count(*) AS n_near, max(x.n) AS top, first(near.v ORDER BY x.n DESC, near.v) AS v
            FROM near JOIN words x ON near.v = x.w GROUP BY near.w),
        known AS (
            SELECT words.w, words.n, coalesce(n_near, 0) AS n_near, CASE WHEN top >= 5 * words.n THEN v END AS form,
                   CASE WHEN top >= 5 * words.n THEN top END AS form_n
            FROM words LEFT JOIN best USING (w)),
        chain AS (
            SELECT w, form AS at FROM known WHERE form IS NOT NULL
            UNION ALL SELECT chain.w, known.form FROM chain JOIN known ON chain.at = known.w WHERE known.form IS NOT NULL),
        ends AS (SELECT chain.w, chain.at FROM chain JOIN known ON chain.at = known.w WHERE known.form IS NULL)
        SELECT known.w AS word, form, coalesce(ends.at, known.w) AS root, n, n_near, form_n FROM known LEFT JOIN ends ON known.w = ends.w
    """,
}
