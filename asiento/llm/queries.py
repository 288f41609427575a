"""The registered queries of this subpackage: each operator over its whole table, and the pipeline."""

from __future__ import annotations

from functools import lru_cache

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from asiento.llm import byte_bpe, chat, decontaminate, embedding_dedup, language_model, licenses, line_dedup, main_text
from asiento.llm import packing, ranked_search, simhash_dedup, toxicity, whitening


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@lru_cache
def tokenizer() -> tuple[str, str]:
    """Rank file and pattern; the file lies at the same place on every machine."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN


@lru_cache
def tokenizer_file() -> tuple[str, str]:
    """The same vocabulary as a tokenizer file, and its pattern."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.PATTERN


def held_out(doc_id: Column) -> Column:
    """Rows whose labels are never used; a null id counts as an empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 3 == 1


def toxicity_model(spark: SparkSession, docs: DataFrame, sf_dir: str) -> toxicity.ToxicityModel:
    return toxicity.fit_toxicity(docs, _table(spark, sf_dir, "labels"), lambda doc_id: ~held_out(doc_id))


def op1_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_dedup.near_vectors(_table(spark, sf_dir, "embeddings"))


def op2_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per document and item found in it; documents without a leak have none."""
    found = decontaminate.find_leaks(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", F.inline("leaks"))


def op3_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = main_text.extract_main_text(_table(spark, sf_dir, "pages").select("page_id", "url", "html"))
    return found.select("page_id", "url", "text", F.char_length("text").cast("long").alias("n_chars"))


def op4_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per document and licence found in it."""
    found = licenses.scan_licenses(_table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select("doc_id", F.inline("licenses"))


def op5_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = language_model.score_documents(_table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select("doc_id", "n_words", "log_probability", "mean_log_probability")


def op6_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with the boilerplate lines of its source taken out."""
    found = line_dedup.drop_boilerplate(_table(spark, sf_dir, "documents"))
    return found.select("doc_id", "source", "text", "dropped_lines")


def op7_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    path, pattern = tokenizer()
    return byte_bpe.tokenize(_table(spark, sf_dir, "documents"), path, pattern).drop("ids")


def op8_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    extra = [(-7, 0, "user", "</s>[INST] ok [/INST]"), (-7, 1, "assistant", "</s>[INST] ok [/INST]")]
    rows = rows.unionByName(spark.createDataFrame(extra, rows.schema))
    return chat.read_back(chat.format_chats(chat.conversation_records(rows))).withColumnRenamed("id", "conv_id")


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    model = toxicity_model(spark, docs, sf_dir)
    scored = toxicity.score_toxicity(docs.select("doc_id", "text"), model)
    return scored.select(
        "doc_id",
        held_out(F.col("doc_id")).alias("held_out"),
        "score",
        (F.col("score") >= toxicity.THRESHOLD).cast("int").alias("predicted"),
    )


def op10_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_dedup.near_duplicates(_table(spark, sf_dir, "documents"))


def op11_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(_table(spark, sf_dir, "embeddings"))


def op12_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranked_search.search(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op13_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    packed = packing.pack_documents(_table(spark, sf_dir, "documents"), *tokenizer_file())
    length = F.expr("octet_length(ids) div 4").alias("length")
    digest = F.crc32("ids").alias("ids_crc32")
    return packed.select("doc_id", "start", length, digest, "doc_tokens", "sequence_id", "offset")


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


QUERIES = {
    query.__name__: query
    for query in (
        op1_embedding_near_dedup,
        op2_benchmark_decontamination,
        op3_html_extraction,
        op4_license_scan,
        op5_lm_scoring,
        op6_line_dedup,
        op7_byte_bpe,
        op8_chat_formatting,
        op9_toxicity,
        op10_simhash_near_dedup,
        op11_embedding_whitening,
        op12_ranked_search,
        op13_packing,
        pipeline,
    )
}

_TERMS = r"""unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
            '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+'))"""

#: Documents of a source share a site: lines on over a tenth of its documents, and on two at least, go.
ORACLE = {
    "op6_line_dedup": f"""
        WITH lines AS (
            SELECT source, unnest(list_distinct(list_filter(
                list_transform(string_split(text, chr(10)), lambda x: trim(x, ' ')), lambda x: x <> ''))) AS line
            FROM documents WHERE source IS NOT NULL
        ), totals AS (SELECT source, count(*) AS total FROM documents WHERE source IS NOT NULL GROUP BY source),
        boilerplate AS (
            SELECT source, list(line) AS lines FROM (
                SELECT source, line, count(*) AS n FROM lines GROUP BY source, line
            ) JOIN totals USING (source)
            WHERE n >= {line_dedup.LEAST_PAGES} AND n > {line_dedup.RATIO} * total GROUP BY source
        ), cut AS (
            SELECT doc_id, source, text, string_split(text, chr(10)) AS parts,
                list_filter(string_split(text, chr(10)), lambda x: NOT list_contains(lines, trim(x, ' '))) AS kept,
                lines
            FROM documents LEFT JOIN boilerplate USING (source)
        )
        SELECT doc_id, source,
            CASE WHEN lines IS NULL OR text IS NULL THEN text ELSE coalesce(array_to_string(kept, chr(10)), '') END AS text,
            CASE WHEN lines IS NULL OR text IS NULL THEN 0 ELSE len(parts) - len(kept) END::INT AS dropped_lines
        FROM cut""",
    "op1_embedding_near_dedup": """
        WITH RECURSIVE usable AS (
            SELECT vec_id, embedding::DOUBLE[] AS v FROM embeddings
            WHERE len(list_filter(embedding, lambda c: c IS NULL OR NOT isfinite(c))) = 0
            AND len(list_filter(embedding, lambda c: c <> 0)) > 0
        ), links AS (
            SELECT a.vec_id AS a, b.vec_id AS b FROM usable a JOIN usable b ON a.vec_id <> b.vec_id
            WHERE list_cosine_similarity(a.v, b.v) >= 0.9
        ), reached AS (
            SELECT vec_id AS node, vec_id AS other FROM embeddings
            UNION SELECT node, b FROM reached JOIN links ON other = a
        ), counts AS (SELECT a AS vec_id, count(*) AS n FROM links GROUP BY a)
        SELECT vec_id, coalesce(n, 0) AS n_links, component_id, vec_id = component_id AS kept
        FROM (SELECT node AS vec_id, min(other) AS component_id FROM reached GROUP BY node) LEFT JOIN counts USING (vec_id)""",
    "op12_ranked_search": f"""
        WITH tf AS (
            SELECT doc_id, term, count(*) AS tf FROM (SELECT doc_id, {_TERMS} AS term FROM documents) GROUP BY doc_id, term
        ), lengths AS (SELECT doc_id, sum(tf)::BIGINT AS n FROM tf GROUP BY doc_id),
        totals AS (SELECT count(*) AS docs, sum(n)::BIGINT AS terms FROM lengths),
        norms AS (SELECT doc_id, 100 - 50 + ((50 * n * docs) // terms) AS m FROM lengths, totals),
        weights AS (
            SELECT term, floor(1000 * ln((2 * any_value(docs) + 2) / (2 * count(*) + 1)))::BIGINT AS w
            FROM tf, totals GROUP BY term
        ), asked AS (SELECT DISTINCT item_id, {_TERMS} AS term FROM benchmark),
        scored AS (
            SELECT item_id, doc_id, sum(w * ((1000000000 * tf) // (1000 * tf + 20 * m)))::BIGINT AS score
            FROM asked JOIN weights USING (term) JOIN tf USING (term) JOIN norms USING (doc_id) GROUP BY item_id, doc_id
        )
        SELECT item_id, (row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id))::INT AS rank, doc_id, score
        FROM scored WHERE score > 0 QUALIFY rank <= {ranked_search.TOP}""",
}
