"""Context retrieval: classify queries, route them to chunk types, rank chunks, build the context."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from granary.functions.text import first_match, word_set
from granary.operators import vectors
from granary.operators.postings import best_by_overlap, word_blocks
from granary.session import materialize

# Key words per query type (first match wins), chunk types per query type in search order.
QUERY_RULES = [
    ("error_analysis", ["error", "fail", "exception", "traceback"]),
    ("schema_question", ["schema", "column", "field", "type"]),
    ("lineage_question", ["lineage", "upstream", "downstream", "depends"]),
    ("documentation", ["what is", "explain", "document", "how does"]),
]
OTHER = "general"
ROUTES = {
    "error_analysis": ["error_pattern", "contract"],
    "schema_question": ["contract", "manifest"],
    "lineage_question": ["manifest"],
    "documentation": ["contract", "manifest"],
    "general": ["contract", "manifest"],
}
MAX_CHUNKS = 5
CHARS_PER_TOKEN = 4
NO_CONTEXT = "No relevant context found."

QUERY_BLOCK = 4096
PIECE_ROWS = 4_000_000


def classify(text: str | Column) -> Column:
    return first_match(text, QUERY_RULES, OTHER)


def routes(spark: SparkSession) -> DataFrame:
    rows = [(q, c, i) for q, types in ROUTES.items() for i, c in enumerate(types)]
    return spark.createDataFrame(rows, "query_type string, chunk_type string, position int")


def route_queries(queries: DataFrame) -> DataFrame:
    """``(query_id, query, query_type, chunk_type, position)``: where each query has to look."""
    typed = queries.withColumn("query_type", classify("query"))
    return typed.join(F.broadcast(routes(queries.sparkSession)), "query_type")


def candidates(queries: DataFrame, chunks: DataFrame) -> DataFrame:
    """Number of candidate chunks and characters per query and chunk type, without pairing rows."""
    per_type = chunks.groupBy("chunk_type").agg(
        F.count(F.lit(1)).alias("candidates"), F.sum(F.length("content")).alias("characters")
    )
    routed = route_queries(queries).select("query_id", "query_type", "chunk_type", "position")
    return routed.join(per_type, "chunk_type")


def rank_keyword(queries: DataFrame, chunks: DataFrame, k: int = MAX_CHUNKS, block: int = 4 * QUERY_BLOCK) -> DataFrame:
    """Best ``k`` chunks per query by shared words / query words, ties in search order.

    Inputs: ``(query_id, query)`` and ``(chunk_id, chunk_type, content)``. Shared words are found on posting lists
    (``operators/postings.py``), by groups of about ``block`` routed queries. Chunks without a shared word only
    fill up short lists: as fewer than ``k`` chunks matched, the first ``2k`` of a type hold enough.
    """
    routed = route_queries(queries).withColumn("_words", word_set("query"))
    asked = routed.select("query_id", "chunk_type", "position", F.size("_words").alias("query_words"), "_words")
    blocks = word_blocks(chunks, word_set("content"))
    local = best_by_overlap(blocks, asked.select("query_id", "chunk_type", "position", F.col("_words").alias("words")), k, block)
    order = Window.partitionBy("query_id").orderBy(F.desc("overlap"), "position", "chunk_id")
    best = local.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).drop("rank")
    best = materialize(best, "matched-chunks")  # at most k rows per query; the texts are read once

    first = Window.partitionBy("chunk_type").orderBy("chunk_id")
    fill = (
        chunks.select("chunk_id", "chunk_type")
        .withColumn("_n", F.row_number().over(first))
        .filter(F.col("_n") <= 2 * k)
        .drop("_n")
    )
    found = best.groupBy("query_id").agg(F.count(F.lit(1)).alias("_found"))
    short = asked.join(found, "query_id", "left").filter(F.coalesce("_found", F.lit(0)) < k)
    zero = (
        short.select("query_id", "chunk_type", "position")
        .join(F.broadcast(fill), "chunk_type")
        .join(best.select("query_id", "chunk_id"), ["query_id", "chunk_id"], "left_anti")
        .select("query_id", "chunk_id", "position", F.lit(0).cast("long").alias("overlap"))
    )
    ranked = best.unionByName(zero).withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    words = routed.select("query_id", "query_type", "position", F.size("_words").alias("query_words"))
    score = F.least(F.col("overlap") / F.greatest("query_words", F.lit(1)), F.lit(1.0))
    return ranked.join(words, ["query_id", "position"]).select(
        "query_id", "query_type", "chunk_id", "rank", "overlap", score.alias("score")
    )


def _unit(rows: np.ndarray) -> np.ndarray:
    norm = np.linalg.norm(rows, axis=1, keepdims=True)
    return np.divide(rows, norm, out=np.zeros_like(rows), where=norm > 0)


def _score_batch(query_ids: np.ndarray, unit_queries: np.ndarray, batch: pd.DataFrame, k: int) -> pd.DataFrame:
    parts = []
    step = max(1, PIECE_ROWS // len(query_ids))
    for start in range(0, len(batch), step):
        piece = batch.iloc[start : start + step]
        ids = piece["chunk_id"].to_numpy()
        scores = _unit(np.stack(piece["embedding"].to_numpy()).astype("float64")) @ unit_queries.T
        if len(ids) > k:  # all that reach a query's k-th best score, ties included
            row, col = np.nonzero(scores >= np.partition(scores, len(ids) - k, axis=0)[len(ids) - k])
        else:
            row, col = np.nonzero(np.ones_like(scores, dtype=bool))
        parts.append(pd.DataFrame({"query_id": query_ids[col], "chunk_id": ids[row], "similarity": scores[row, col]}))
    return _keep_best(pd.concat(parts, ignore_index=True), k)


def _keep_best(rows: pd.DataFrame, k: int) -> pd.DataFrame:
    ordered = rows.sort_values(["query_id", "similarity", "chunk_id"], ascending=[True, False, True])
    return ordered.groupby("query_id", sort=False).head(k)


def rank_embedding(queries: DataFrame, chunks: DataFrame, k: int = MAX_CHUNKS, block: int = QUERY_BLOCK) -> DataFrame:
    """Best ``k`` chunks per query by cosine similarity.

    Inputs: ``(query_id, embedding)`` and ``(chunk_id, embedding)``. Up to ``block`` queries are
    broadcast and each task keeps its best ``k`` per query, in one pass over the chunks. For more queries an exact index is
    built (``operators/vectors.py``), so that a query meets only the cells that can hold its best.
    """
    schema = "query_id bigint, chunk_id bigint, similarity double"
    queries = queries.select(F.col("query_id").cast("long"), "embedding")
    chunks = chunks.select(F.col("chunk_id").cast("long"), "embedding").filter(F.col("embedding").isNotNull())
    spark = queries.sparkSession
    head = queries.limit(block + 1).collect()  # at most block + 1 rows
    if not head:
        return spark.createDataFrame([], "query_id bigint, chunk_id bigint, similarity double, rank int")
    if len(head) <= block:
        ids = np.array([r["query_id"] for r in head])
        shared = spark.sparkContext.broadcast((ids, _unit(np.array([r["embedding"] for r in head], dtype="float64"))))

        def scan(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            query_ids, unit_queries = shared.value
            best = None
            for batch in batches:
                if len(batch):
                    found = _score_batch(query_ids, unit_queries, batch, k)
                    best = found if best is None else _keep_best(pd.concat([best, found]), k)
            if best is not None:
                yield best

        local = chunks.mapInPandas(scan, schema)
    else:
        return vectors.search(vectors.build(chunks), queries, k)
    order = Window.partitionBy("query_id").orderBy(F.desc("similarity"), "chunk_id")
    return local.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def build_context(ranked: DataFrame, chunks: DataFrame) -> DataFrame:
    """Prompt text and token estimate per query; lists have at most ``k`` chunks each.

    Inputs: ``rank_keyword`` output and ``(chunk_id, chunk_type, source, content)``.
    """
    body = F.format_string(
        "[%d] Source: %s\nType: %s\nContent:\n%s\n", "rank", "source", "chunk_type", "content"
    )
    # written, the ranks are joined by their size on disk: broadcast if small
    ranks = materialize(ranked.select("query_id", "query_type", "chunk_id", "rank"), "ranks")
    joined = chunks.join(ranks, "chunk_id")
    listed = joined.groupBy("query_id", "query_type").agg(
        F.sort_array(F.collect_list(F.struct("rank", body.alias("part")))).alias("_parts"),
        F.count(F.lit(1)).alias("chunks"),
        F.floor(F.sum(F.length("content")) / CHARS_PER_TOKEN).alias("estimated_tokens"),
    )
    return listed.select(
        "query_id", "query_type", "chunks", "estimated_tokens", F.array_join("_parts.part", "\n---\n").alias("context")
    )


def union_sources(*sources: DataFrame) -> DataFrame:
    """Chunks of several sources in one frame."""
    out = sources[0]
    for s in sources[1:]:
        out = out.unionByName(s, allowMissingColumns=True)
    return out


def error_pattern_chunks(spark: SparkSession, resolved: DataFrame) -> DataFrame:
    """Chunks from resolved errors ``(error, root_cause, resolution, category)``."""
    content = F.to_json(F.struct("error", "root_cause", "resolution", "category"))
    return resolved.select(
        content.alias("content"),
        F.lit("error_history").alias("source"),
        F.lit("error_pattern").alias("chunk_type"),
        F.create_map(F.lit("category"), F.col("category")).alias("metadata"),
    )
