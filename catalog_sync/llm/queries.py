"""One query per operator over its whole table, with the SQL that must give the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from catalog_sync.llm.byte_bpe import decode, encode
from catalog_sync.llm.hard_negatives import hard_negatives
from catalog_sync.llm.impact_search import top_k
from catalog_sync.llm.line_dedup import drop_repeated_lines
from catalog_sync.llm.minhash import near_duplicates
from catalog_sync.llm.max_sketch import search
from catalog_sync.llm.mixing import copies
from catalog_sync.llm.shared import ship
from catalog_sync.llm.site_style import main_texts
from catalog_sync.llm.sync_packing import pack
from catalog_sync.llm.tokens import pieces
from catalog_sync.llm.toxicity import score_toxicity
from catalog_sync.llm.tree_packing import packed_rows
from catalog_sync.llm.vector_dedup import near_vectors
from catalog_sync.llm.warc import round_trip
from catalog_sync.plans.registry import table
from catalog_sync.scratch import stage

SEQUENCE = 2048


def tokenizer(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


Run = Callable[[SparkSession, str], DataFrame]
RUNS: dict[str, Run] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Run], Run]:
    def add(run: Run) -> Run:
        def shipped(spark: SparkSession, sf_dir: str) -> DataFrame:
            ship(spark)
            return run(spark, sf_dir)

        RUNS[name] = shipped
        if sql:
            SQL[name] = sql
        return run

    return add


def sha256(text: str) -> F.Column:
    return F.sha2(F.coalesce(F.col(text), F.lit("")).cast("binary"), 256)


@query("op5_line_dedup", r"""
WITH lines AS (
    SELECT doc_id, i, line, lower_ascii AS k FROM (
        SELECT doc_id, i, parts[i] AS line,
            translate(regexp_replace(parts[i], '^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$', '', 'g'),
                'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS lower_ascii
        FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS parts FROM documents)
        CROSS JOIN LATERAL (SELECT unnest(generate_series(1, len(parts))) AS i)
    )
), gone AS (
    SELECT k FROM lines WHERE k <> '' GROUP BY k HAVING count(DISTINCT doc_id) >= 10
)
SELECT doc_id, count(*) AS n_lines, count(g.k) AS n_dropped,
    sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (WHERE g.k IS NULL), '')) AS kept_sha256
FROM lines LEFT JOIN gone g USING (k) GROUP BY doc_id
""")
def op5_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = drop_repeated_lines(table(spark, sf_dir, "documents").select("doc_id", "text"), min_docs=10)
    return out.select("doc_id", "n_lines", "n_dropped", sha256("text").alias("kept_sha256"))


@query("op6_minhash_near_dedup")
def op6_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"), words=2, percent=80)


@query("op3_best_fit_packing")
def op3_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = stage(
        pieces(table(spark, sf_dir, "documents"), "doc_id", "text", tokenizer("word_bpe_49k.json"), SEQUENCE, 0),
        "pieces",
    ).withColumnRenamed("key", "doc_id")
    return pack(cut, ["doc_id", "piece", "ids_crc32"], SEQUENCE)


@query("op7_source_mixing", r"""
WITH sized AS (
    SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size
    FROM documents
), totals AS (
    SELECT source, sum(size)::BIGINT AS source_size FROM sized GROUP BY source
), weighed AS (
    SELECT *, 2 * source_size AS cap,
        [3.0::DOUBLE, 1.0::DOUBLE, 2.0::DOUBLE][1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3] AS w
    FROM totals
), laid AS (
    SELECT *, row_number() OVER o AS n,
        coalesce(sum(cap) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS capped,
        sum(w) OVER (o ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS free,
        1.5::DOUBLE * sum(source_size) OVER () AS budget
    FROM weighed WINDOW o AS (ORDER BY cap / w, source)
), level AS (
    SELECT n, (budget - capped) / free AS y FROM laid WHERE cap >= (budget - capped) / free * w
    ORDER BY n LIMIT 1
), goals AS (
    SELECT source, source_size, CASE WHEN laid.n < level.n THEN cap::DOUBLE ELSE level.y * w END AS target,
        CASE WHEN source_size > 0 THEN target / source_size ELSE 0 END AS rate,
        ('0x' || md5('mix' || coalesce(source, ''))[1:5])::BIGINT / 1048576.0::DOUBLE AS u
    FROM laid, level
), ranked AS (
    SELECT *, row_number() OVER (PARTITION BY source ORDER BY size, doc_id) - 1 AS r FROM sized
)
SELECT doc_id, size, source_size, target,
    size * least(floor(rate * (r + 1) + u) - floor(rate * r + u), ceil(rate))::BIGINT AS taken
FROM ranked JOIN goals ON ranked.source IS NOT DISTINCT FROM goals.source
""")
def op7_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return copies(table(spark, sf_dir, "documents")).select(
        "doc_id", "size", "source_size", "target", "taken"
    )


@query("op1_embedding_near_dedup")
def op1_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_vectors(table(spark, sf_dir, "embeddings"), threshold=0.95)


@query("op4_warc_reassembly")
def op4_warc_reassembly(spark: SparkSession, sf_dir: str) -> DataFrame:
    return round_trip(table(spark, sf_dir, "pages"), min_bytes=0).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"
    )


@query("op8_exact_top_k")
def op8_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_k(table(spark, sf_dir, "embeddings"), F.col("id") % 100 == 0, k=10)


@query("op2_token_matrices")
def op2_token_matrices(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packed_rows(
        table(spark, sf_dir, "documents"), tokenizer("word_bpe_49k.json"), size=SEQUENCE
    )


@query("op9_toxicity")
def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), threshold=0.3)


@query("op10_site_style_text")
def op10_site_style_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return main_texts(table(spark, sf_dir, "pages"))


@query("op13_byte_bpe")
def op13_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    from public_tokenizers import PATTERN

    ranks = tokenizer("byte_bpe_multi_50k.tiktoken")
    coded = encode(table(spark, sf_dir, "documents").select("doc_id", "text"), "text", ranks, PATTERN)
    back = decode(coded, ranks, PATTERN)
    return back.select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.concat_ws(",", F.col("ids").cast("array<string>")), 256).alias("ids_sha256"),
        F.sha2("bytes", 256).alias("decoded_sha256"),
    )


@query("op12_lexical_search", r"""
WITH terms AS (
    SELECT doc_id, term, count(*) AS tf FROM (
        SELECT doc_id, unnest(regexp_extract_all(
            translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
            '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM documents
    ) GROUP BY doc_id, term
), asked AS (
    SELECT DISTINCT item_id, unnest(regexp_extract_all(
        translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark
), sized AS (
    SELECT doc_id, sum(tf)::BIGINT AS n FROM terms GROUP BY doc_id
), corpus AS (
    SELECT count(*)::BIGINT AS docs, sum(n)::BIGINT AS length FROM sized
), norms AS (
    SELECT doc_id, 10 + (90 * n * docs) // length AS m FROM sized, corpus
), weights AS (
    SELECT term, floor(1000 * ln((2 * docs + 2)::DOUBLE / (2 * df + 1)::DOUBLE))::BIGINT AS w
    FROM (SELECT term, count(*) AS df FROM terms GROUP BY term), corpus
), scores AS (
    SELECT item_id, doc_id, sum(w * ((1000000000 * tf) // (1000 * tf + 8 * m)))::BIGINT AS score
    FROM asked JOIN weights USING (term) JOIN terms USING (term) JOIN norms USING (doc_id)
    GROUP BY item_id, doc_id HAVING score > 0
)
SELECT item_id, rank::INT AS rank, doc_id, score FROM (
    SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank FROM scores
) WHERE rank <= 10
""")
def op12_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), k=10)


@query("op11_hard_negatives", """
WITH known AS (
    SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
        list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS units
    FROM embeddings
    WHERE label IS NOT NULL AND len(embedding) > 0
        AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), pairs AS (
    SELECT a.vec_id AS anchor_id, b.vec_id AS id, a.label = b.label AS alike,
        list_dot_product(a.units, b.units)::BIGINT AS score
    FROM known a JOIN known b ON a.vec_id <> b.vec_id WHERE a.vec_id % 50 = 0
), positives AS (
    SELECT anchor_id, id AS positive_id, score AS positive_score FROM pairs WHERE alike
    QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5
)
SELECT anchor_id, positive_id,
    row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, id)::INT AS rank,
    id AS negative_id, positive_score, score AS negative_score
FROM positives JOIN pairs USING (anchor_id)
WHERE NOT alike AND 50 * positive_score <= 100 * score AND 100 * score <= 95 * positive_score
QUALIFY row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, id) <= 3
""")
def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    turned = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    vectors = table(spark, sf_dir, "embeddings").withColumn("label", turned)
    return hard_negatives(vectors, F.col("id") % 50 == 0)
