"""The registered queries of this subpackage: thin digests of its operators."""

from collections.abc import Callable
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marquee.llm import (
    curriculum, divergence, infill, jaccard, language, neighbours, packing, pages, phrases, quality, simhash, sql,
    substrings, tokens,
)
from marquee.llm.frames import bucket_of, table


class Query(NamedTuple):
    run: Callable[[SparkSession, str], DataFrame]
    sql: str | None


QUERIES: dict[str, Query] = {}


def query(name, text=None):
    def register(run):
        QUERIES[name] = Query(run, text)
        return run

    return register


@query("op1_substring_dedup", sql.REPEATS)
def op1(spark, folder):
    documents = table(spark, folder, "documents").select("doc_id", "text")
    return substrings.remove_repeats(documents, window=35, with_text=False).select(
        "doc_id", "n_words", "n_removed", F.col("kept").alias("kept_sha256")
    )


@query("op2_language")
def op2(spark, folder):
    documents = table(spark, folder, "documents")
    model = language.train(documents)
    return language.identify(documents.select("doc_id", "text"), model).select(
        "doc_id", F.coalesce(bucket_of("doc_id", 4) == 2, F.lit(False)).alias("held_out"), "lang_pred", "score"
    )


@query("op3_main_text")
def op3(spark, folder):
    return pages.main_text(table(spark, folder, "pages"))


@query("op4_divergence", sql.DIVERGENCE)
def op4(spark, folder):
    documents = table(spark, folder, "documents").select("doc_id", "lang", "text")
    return divergence.quality(documents, with_text=False).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept",
        F.round("class_distance", 6).alias("class_distance"), F.round("word_distance", 6).alias("word_distance"),
    )


@query("op5_quality")
def op5(spark, folder):
    documents = table(spark, folder, "documents").select("doc_id", "text")
    model = quality.train(documents, table(spark, folder, "labels"))
    return quality.score(documents, model, keep_text=False).select(
        "doc_id", F.coalesce(bucket_of("doc_id", 5) == 0, F.lit(False)).alias("held_out"), "score", "predicted"
    )


@query("op6_simhash")
def op6(spark, folder):
    documents = table(spark, folder, "documents").select("doc_id", "text")
    return simhash.groups(documents, shingle=3, distance=3).select(
        "doc_id", F.lower(F.lpad(F.hex("print"), 16, "0")).alias("fingerprint"), "component_id"
    )


@query("op7_token_counts")
def op7(spark, folder):
    return tokens.count(table(spark, folder, "documents").select("doc_id", "text"))


@query("op8_mixing", """
    WITH sizes AS (
        SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS size,
               md5(coalesce(CAST(doc_id AS VARCHAR), '')) AS place
        FROM documents),
    sums AS (SELECT source, sum(size)::BIGINT AS source_size FROM sizes GROUP BY source),
    turns AS (SELECT *, (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 AS turn FROM sums),
    weights AS (
        SELECT *, [5.0, 2.0, 1.0][turn + 1]::DOUBLE AS weight, [6.0, 2.0, 0.5][turn + 1]::DOUBLE AS begin_w,
               [4.0, 2.0, 1.5][turn + 1]::DOUBLE AS end_w FROM turns),
    levels AS (SELECT *, source_size * 2 / weight AS full_at FROM weights),
    steps AS (
        SELECT *, (sum(source_size) OVER () * 1.5::DOUBLE - 2 * coalesce(sum(source_size) OVER (
                       ORDER BY full_at, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
                  / sum(weight) OVER (ORDER BY full_at, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level,
               row_number() OVER (ORDER BY full_at, source NULLS LAST) AS pos
        FROM levels),
    goals AS (
        SELECT *, least(source_size * 2.0::DOUBLE, weight * coalesce(
            (SELECT arg_min(level, pos) FROM steps WHERE level <= full_at), 'inf'::DOUBLE)) AS target
        FROM steps),
    placed AS (
        SELECT s.doc_id, s.size, g.source_size, g.target, g.begin_w, g.end_w,
               CASE WHEN g.source_size > 0 THEN floor(g.target / g.source_size) ELSE 0 END AS passes,
               coalesce(sum(s.size) OVER (PARTITION BY s.source ORDER BY s.place, s.doc_id, s.size
                   ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
        FROM sizes s JOIN goals g ON s.source IS NOT DISTINCT FROM g.source),
    cut AS (SELECT *, floor(target - passes * source_size) AS rest FROM placed),
    took AS (
        SELECT *, (passes * size + least(before + size, rest) - least(before, rest))::BIGINT AS taken,
               before / target AS demand
        FROM cut)
    SELECT doc_id, size, source_size, round(target, 6) AS target, taken,
           round(CASE WHEN taken > 0 THEN CASE WHEN begin_w = end_w THEN demand
               ELSE (sqrt(begin_w * begin_w + (end_w - begin_w) * (begin_w + end_w) * demand) - begin_w) / (end_w - begin_w)
               END END, 9) AS position
    FROM took""")
def op8(spark, folder):
    documents = table(spark, folder, "documents").select("doc_id", "text", "source")
    return curriculum.ordered(curriculum.sized(documents).drop("text")).select(
        "doc_id", "size", "source_size", F.round("target", 6).alias("target"), "taken",
        F.round("position", 9).alias("position"),
    )


@query("op9_nearest", """
    WITH usable AS (
        SELECT vec_id, embedding::DOUBLE[] AS v FROM embeddings
        WHERE len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
          AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
    scored AS (
        SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.v, c.v) AS score
        FROM usable q JOIN usable c ON q.vec_id % 20 = 0 AND c.vec_id <> q.vec_id),
    ranked AS (
        SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank FROM scored)
    SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 20""")
def op9(spark, folder):
    vectors = table(spark, folder, "embeddings").select("vec_id", "embedding")
    return neighbours.nearest(vectors.filter("vec_id % 20 = 0"), vectors, k=20)


@query("op10_packing")
def op10(spark, folder):
    return packing.pack(table(spark, folder, "documents").select("doc_id", "text"))


@query("op13_infill", sql.INFILL)
def op13(spark, folder):
    documents = table(spark, folder, "documents").select("doc_id", "text")
    moved = infill.transform(documents)
    restored = infill.restored(F.col("output"), F.col("form"))
    return moved.select(
        "doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2(F.col("output").cast("binary"), 256).alias("output_sha256"),
        F.sha2(restored.cast("binary"), 256).alias("restored_sha256"),
    )


@query("op11_phrases", sql.PHRASES)
def op11(spark, folder):
    return phrases.collocations(table(spark, folder, "documents"), support=30, top=2000, cover=80)


@query("op12_jaccard", sql.SIMILAR)
def op12(spark, folder):
    documents = table(spark, folder, "documents").select("doc_id", "text")
    return jaccard.groups(documents, shingle=5, percent=80)
