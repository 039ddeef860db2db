"""The registered queries of this folder and their SQL for DuckDB."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tramline.llm import chat, collocations, fingerprints, languages, licenses, mixing, ngram_join, packing, runs, secrets, sharding, topk, toxicity
from tramline.llm.common import table

Query = Callable[[SparkSession, str], DataFrame]


def op1_mixing(spark: SparkSession, folder: str) -> DataFrame:
    mixed = mixing.mix(table(spark, folder, "documents"))
    return mixed.select(
        "doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"), "copies"
    )


def op2_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    documents = table(spark, folder, "documents")
    model = toxicity.fit(documents, table(spark, folder, "labels"))
    return model.score(documents.select("doc_id", "text")).select(
        "doc_id",
        toxicity.held_out(F.col("doc_id")).alias("held_out"),
        "score",
        (F.col("score") >= toxicity.TOXIC_FROM).cast("int").alias("predicted"),
    )


def op3_secret_scans(spark: SparkSession, folder: str) -> DataFrame:
    return secrets.span_report(table(spark, folder, "documents"))


def op4_sharding(spark: SparkSession, folder: str) -> DataFrame:
    placed = sharding.assign_shards(table(spark, folder, "documents"))
    return placed.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("rows").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op5_best_fit_packing(spark: SparkSession, folder: str) -> DataFrame:
    return packing.packed_documents(table(spark, folder, "documents"))


def op6_ngram_jaccard_join(spark: SparkSession, folder: str) -> DataFrame:
    return ngram_join.near_classes(table(spark, folder, "documents"))


def op7_license_scans(spark: SparkSession, folder: str) -> DataFrame:
    """Per document the licenses its notices name, and every notice's place and containment."""
    place = lambda f: F.concat_ws(":", f["license"], f["start"], f["end"], F.round(f["containment"], 4))
    return licenses.scan_licenses(table(spark, folder, "documents")).select(
        "doc_id",
        F.size("found").cast("long").alias("n_notices"),
        F.array_join(F.array_sort(F.array_distinct(F.transform("found", lambda f: f["license"]))), ",").alias("licenses"),
        F.array_join(F.transform("found", place), ",").alias("notices"),
    )


def op8_chat_formatting(spark: SparkSession, folder: str) -> DataFrame:
    """All conversations and conversation -1, whose texts are control strings themselves."""
    spoken = "</s>[INST] ok [/INST]"
    planted = spark.createDataFrame(
        [(-1, 0, "user", spoken), (-1, 1, "assistant", spoken)], "conv_id long, turn long, role string, text string"
    )
    rows = table(spark, folder, "conversations").select("conv_id", "turn", "role", "text")
    return chat.read_back(chat.format_turns(rows.unionByName(planted)))


def op9_document_fingerprints(spark: SparkSession, folder: str) -> DataFrame:
    return fingerprints.fingerprint_pairs(table(spark, folder, "documents"))


def op10_exact_top_k(spark: SparkSession, folder: str) -> DataFrame:
    return topk.search(topk.whole_vectors(table(spark, folder, "embeddings")), F.col("vec_id") % 50 == 0)


def op11_periodic_runs(spark: SparkSession, folder: str) -> DataFrame:
    return runs.scan_runs(table(spark, folder, "documents"), edit=True).drop("runs", "collapsed")


def op12_phrase_collocations(spark: SparkSession, folder: str) -> DataFrame:
    return collocations.collocations(table(spark, folder, "documents"))


def op13_language_id(spark: SparkSession, folder: str) -> DataFrame:
    documents = table(spark, folder, "documents")
    return languages.fit(documents).predict(documents).select(
        "doc_id", toxicity.held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score"
    )


QUERIES: dict[str, Query] = {
    "op1_mixing": op1_mixing,
    "op2_toxicity": op2_toxicity,
    "op3_secret_scans": op3_secret_scans,
    "op4_sharding": op4_sharding,
    "op5_best_fit_packing": op5_best_fit_packing,
    "op6_ngram_jaccard_join": op6_ngram_jaccard_join,
    "op7_license_scans": op7_license_scans,
    "op8_chat_formatting": op8_chat_formatting,
    "op9_document_fingerprints": op9_document_fingerprints,
    "op10_exact_top_k": op10_exact_top_k,
    "op11_periodic_runs": op11_periodic_runs,
    "op12_phrase_collocations": op12_phrase_collocations,
    "op13_language_id": op13_language_id,
}

_COLLOCATIONS = r"""
WITH pieces AS (
    SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
    FROM documents
), lists AS (
    SELECT lang, w, len(w) AS n FROM (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces) WHERE len(w) > 0
), totals AS (
    SELECT lang, CAST(sum(n) AS BIGINT) AS n FROM lists GROUP BY lang
), starts AS (
    SELECT lang, w, n, unnest(range(1, n + 1)) AS i FROM lists
), grams AS (
    SELECT lang, s, array_to_string(w[i:i + s - 1], ' ') AS phrase
    FROM (SELECT *, unnest([1, 2, 3, 4, 5]) AS s FROM starts) WHERE i + s - 1 <= n
), counts AS (
    SELECT lang, s, phrase, count(*) AS f FROM grams GROUP BY lang, s, phrase HAVING count(*) >= 100
), candidates AS (
    SELECT lang, s, phrase, f AS a FROM counts WHERE s >= 2
), kept AS (
    SELECT * FROM candidates c WHERE NOT EXISTS (
        SELECT 1 FROM candidates d WHERE d.lang = c.lang AND d.s > c.s AND d.a >= c.a
        AND contains(' ' || d.phrase || ' ', ' ' || c.phrase || ' '))
), cuts AS (
    SELECT *, string_split(phrase, ' ') AS p, unnest(range(1, s)) AS k FROM kept
), scored AS (
    SELECT c.lang, c.phrase, c.a, c.k, l.f AS l, r.f AS r, t.n,
        (1000::HUGEINT * c.a * t.n) // (l.f::HUGEINT * r.f) AS score
    FROM cuts c JOIN totals t ON t.lang = c.lang
    JOIN counts l ON l.lang = c.lang AND l.phrase = array_to_string(c.p[1:c.k], ' ')
    JOIN counts r ON r.lang = c.lang AND r.phrase = array_to_string(c.p[c.k + 1:c.s], ' ')
), weakest AS (
    SELECT *, row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) AS nth FROM scored
), ranked AS (
    SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM weakest WHERE nth = 1
)
SELECT lang, CAST(rank AS BIGINT) AS rank, phrase, CAST(a AS BIGINT) AS a, CAST(l AS BIGINT) AS l, CAST(r AS BIGINT) AS r,
    n, CAST(score AS BIGINT) AS score
FROM ranked WHERE rank <= 2000
"""

_TOP_K = """
WITH vectors AS (
    SELECT row_number() OVER () AS row, vec_id, [floor(256 * CAST(x AS DOUBLE)) for x in embedding] AS v
    FROM embeddings
    WHERE embedding IS NOT NULL
    AND len([x for x in embedding if x IS NULL OR isnan(x) OR isinf(x)]) = 0
), scored AS (
    SELECT q.row, q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.v, c.v) AS BIGINT) AS score
    FROM vectors q JOIN vectors c ON c.row <> q.row
    WHERE q.vec_id % 50 = 0
)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY row ORDER BY score DESC, vec_id NULLS LAST) AS rank FROM scored)
WHERE rank <= 5
"""

ORACLE: dict[str, str] = {"op10_exact_top_k": _TOP_K, "op12_phrase_collocations": _COLLOCATIONS}
