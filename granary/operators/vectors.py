"""An exact vector index: cells around centres, pruned by the triangle inequality.

``build`` fits centres on a bounded sample (``SAMPLE`` vectors, those whose ids hash lowest), assigns every vector to its
nearest centre and writes the index partitioned by cell: a row holds a block of at most ``BLOCK_ROWS`` vectors of one cell,
sorted by their distance to the centre, with the least and largest of these distances. The centres' table is bounded by
``MAX_CELLS``.

``search`` is exact for any number of queries. Distances are chords between unit vectors, so the nearest are those of the
highest cosine. A query first visits the nearest cells that hold ``k`` vectors, which bounds its k-th distance; then those
other cells whose ring around the centre can come that close. Blocks whose own ring is too far are not compared. Queries
visit a cell in groups of about ``GROUP_ROWS``; a hot cell is many blocks, which adaptive execution spreads.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from granary.session import fresh_path, materialize

SAMPLE = 20_000
MAX_CELLS = 4096
BLOCK_ROWS = 4096
GROUP_ROWS = 1024
#: Distances are compared with this much room, so that rounding never prunes a vector.
ROOM = 1e-9


@dataclass
class Index:
    """``blocks``: cell, block, low, high, ids, vectors; ``cells``: cell, n, low, high; ``centres``: one row per cell."""

    blocks: DataFrame
    cells: pd.DataFrame
    centres: np.ndarray


def unit(rows: np.ndarray) -> np.ndarray:
    norm = np.linalg.norm(rows, axis=1, keepdims=True)
    return np.divide(rows, norm, out=np.zeros_like(rows), where=norm > 0)


def fit(sample: np.ndarray, cells: int, rounds: int = 12, seed: int = 7) -> np.ndarray:
    """Centres of unit vectors: farthest-first starts on a few candidates, then Lloyd's rounds."""
    rng = np.random.default_rng(seed)
    centres = sample[rng.choice(len(sample), min(cells, len(sample)), replace=False)]
    for _ in range(rounds):
        nearest = np.concatenate([(part @ centres.T).argmax(axis=1) for part in np.array_split(sample, max(1, len(sample) // 4096))])
        sums = np.zeros_like(centres)
        np.add.at(sums, nearest, sample)
        filled = np.bincount(nearest, minlength=len(centres)) > 0
        centres = np.where(filled[:, None], unit(sums), centres)
    return centres


def build(chunks: DataFrame, cells: int | None = None, block_rows: int = BLOCK_ROWS) -> Index:
    """Index of ``(chunk_id, embedding)``; null embeddings are left out, those of length 0 point nowhere (cosine 0)."""
    spark = chunks.sparkSession
    rows = chunks.select(F.col("chunk_id").cast("long"), "embedding").filter(F.col("embedding").isNotNull())
    total = rows.count()
    sample = rows.orderBy(F.xxhash64("chunk_id"), "chunk_id").limit(SAMPLE).collect()
    dims = len(sample[0]["embedding"]) if sample else 1
    cells = cells or min(MAX_CELLS, max(1, math.isqrt(total)))
    centres = fit(unit(np.array([r["embedding"] for r in sample], "float64")), cells) if sample else np.zeros((1, dims))
    sent = spark.sparkContext.broadcast(centres)

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            raw = np.stack(batch.column(1).to_numpy(zero_copy_only=False)).astype("float64")
            cosine = unit(raw) @ sent.value.T
            cell = cosine.argmax(axis=1)
            far = np.sqrt(((unit(raw) - sent.value[cell]) ** 2).sum(axis=1))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(cell, pa.int32()), pa.array(far)], names=["chunk_id", "embedding", "cell", "far"])

    kind = rows.schema["embedding"].dataType.simpleString()
    assigned = rows.mapInArrow(assign, f"chunk_id bigint, embedding {kind}, cell int, far double")
    # a cell is spread over as many tasks as its rows need: range partitions by (cell, distance, id) cut hot cells
    ordered = assigned.repartitionByRange(max(1, -(-total // (4 * block_rows))), "cell", "far", "chunk_id").sortWithinPartitions("cell", "far", "chunk_id")
    path = fresh_path(spark, "vector-index")
    ordered.mapInArrow(_blocks(block_rows), BLOCKS).write.partitionBy("cell").parquet(path)
    blocks = spark.read.schema(BLOCKS).parquet(path)
    sizes = blocks.groupBy("cell").agg(F.sum(F.size("ids")).alias("n"), F.min("low").alias("low"), F.max("high").alias("high"))
    return Index(blocks, sizes.toPandas(), centres)  # one row per cell


BLOCKS = "low double, high double, ids array<bigint>, vectors binary, cell int"


def _blocks(block_rows: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []

        def cut(rows: pa.Table, whole: bool) -> tuple[list[pa.RecordBatch], pa.Table]:
            cell = rows.column("cell").to_numpy()
            edges = [0, *(np.flatnonzero(np.diff(cell)) + 1).tolist(), len(cell)]
            out, rest = [], rows.slice(len(rows))
            for a, b in zip(edges, edges[1:], strict=False):
                for x in range(a, b, block_rows):
                    y = min(b, x + block_rows)
                    if not whole and y == len(cell) and y - x < block_rows:
                        rest = rows.slice(x)  # the block may go on in the next batch
                        break
                    out.append(_block(rows.slice(x, y - x)))
            return out, rest

        rest = None
        for batch in batches:
            held = [batch] if rest is None or not len(rest) else [*rest.to_batches(), batch]
            out, rest = cut(pa.Table.from_batches(held), False)
            yield from out
        if rest is not None and len(rest):
            yield from cut(rest, True)[0]

    return run


def _block(rows: pa.Table) -> pa.RecordBatch:
    far = rows.column("far").to_numpy()
    vectors = np.stack(rows.column("embedding").to_numpy()).astype("float64")
    columns = [pa.array([far.min()]), pa.array([far.max()]), pa.array([rows.column("chunk_id").to_numpy()], pa.list_(pa.int64())), pa.array([vectors.tobytes()], pa.binary())]
    return pa.RecordBatch.from_arrays([*columns, pa.array([rows.column("cell")[0].as_py()], pa.int32())], names=["low", "high", "ids", "vectors", "cell"])


def search(index: Index, queries: DataFrame, k: int, group_rows: int = GROUP_ROWS) -> DataFrame:
    """``(query_id, chunk_id, similarity, rank)``: the ``k`` highest cosines, equal ones by id."""
    first = materialize(_compare(index, _to_visit(index, queries, k), k, group_rows), "first-cells")
    order = Window.partitionBy("query_id").orderBy(F.desc("similarity"), "chunk_id")
    kth = _best(first, order, k).groupBy("query_id").agg(F.when(F.count("*") >= k, F.min("similarity")).alias("kth"))
    more = _compare(index, _to_visit(index, queries.join(kth, "query_id", "left"), k), k, group_rows)
    return _best(first.unionByName(more), order, k)


def share_read(index: Index, queries: DataFrame, k: int) -> float:
    """Vectors in the cells that the queries visit, as a share of queries times vectors."""
    first = _to_visit(index, queries, k)
    order = Window.partitionBy("query_id").orderBy(F.desc("similarity"), "chunk_id")
    kth = _best(_compare(index, first, k, GROUP_ROWS), order, k).groupBy("query_id").agg(F.when(F.count("*") >= k, F.min("similarity")).alias("kth"))
    visits = first.select("cell").unionAll(_to_visit(index, queries.join(kth, "query_id", "left"), k).select("cell")).groupBy("cell").count().collect()
    n = dict(zip(index.cells["cell"], index.cells["n"], strict=True))
    return sum(r["count"] * n[r["cell"]] for r in visits) / max(1, sum(n.values()) * queries.count())


def _best(found: DataFrame, order, k: int) -> DataFrame:
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def _to_visit(index: Index, queries: DataFrame, k: int) -> DataFrame:
    """``(query_id, vector, cell, kth)``. Without a column ``kth``: the nearest cells that hold k vectors together. With it:
    all other cells that can hold a vector of that cosine."""
    second = "kth" in queries.columns
    names = ["query_id", "embedding", *(["kth"] if second else [])]
    cells = index.cells.sort_values("cell")
    sent = queries.sparkSession.sparkContext.broadcast((index.centres[cells["cell"].to_numpy()], cells[["cell", "n", "low", "high"]].to_numpy("float64")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        centres, cells = sent.value
        for batch in batches:
            if not batch.num_rows or not len(cells):
                continue
            q = unit(np.stack(batch.column(1).to_numpy(zero_copy_only=False)).astype("float64"))
            far = np.sqrt(np.maximum(0, ((q[:, None, :] - centres[None, :, :]) ** 2).sum(axis=2)) if len(q) * centres.size < 1 << 24 else np.maximum(0, (q**2).sum(axis=1)[:, None] + (centres**2).sum(axis=1) - 2 * q @ centres.T))
            order = np.argsort(far, axis=1, kind="stable")
            before = np.cumsum(cells[order, 1], axis=1) - cells[order, 1]
            initial = np.zeros(far.shape, bool)
            np.put_along_axis(initial, order, before < k, axis=1)
            kth = np.full(len(q), np.nan)
            if second:
                kth = batch.column(2).to_numpy(zero_copy_only=False).astype("float64")
                reach = np.sqrt(np.maximum(0, 2 - 2 * np.where(np.isnan(kth), -1, kth))) + ROOM + 1e-6
                ring = np.maximum(0, np.maximum(far - cells[:, 3], cells[:, 2] - far))
                visit = ~initial & ((ring <= reach[:, None]) | (np.linalg.norm(q, axis=1) == 0)[:, None])
            else:
                visit = initial
            row, col = np.nonzero(visit)
            take = pa.array(row)
            out = [batch.column(0).take(take), batch.column(1).take(take), pa.array(cells[col, 0].astype(np.int32)), pa.array(kth[row], from_pandas=True)]
            for at in range(0, len(row), 10_000):
                yield pa.RecordBatch.from_arrays([c.slice(at, 10_000) for c in out], names=["query_id", "vector", "cell", "kth"])

    rows = queries.select(F.col("query_id").cast("long"), *names[1:]).filter(F.col("embedding").isNotNull())
    return rows.mapInArrow(run, f"query_id bigint, vector {rows.schema['embedding'].dataType.simpleString()}, cell int, kth double")


def _compare(index: Index, visits: DataFrame, k: int, group_rows: int) -> DataFrame:
    """The best ``k`` of every block for the queries that visit its cell."""
    groups = max(1, -(-visits.select("query_id").distinct().count() // group_rows))
    asking = visits.groupBy("cell", F.pmod(F.xxhash64("query_id"), F.lit(groups)).alias("group")).agg(F.collect_list(F.struct("query_id", "vector", "kth")).alias("asking"))
    joined = index.blocks.join(asking, "cell").select("cell", "low", "high", "ids", "vectors", "asking")
    sent = index.blocks.sparkSession.sparkContext.broadcast(index.centres)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for n in range(batch.num_rows):
                cell, low, high = (batch.column(c)[n].as_py() for c in range(3))
                asking = batch.column(5)[n].values
                ids, vectors, kth = (x.to_numpy(zero_copy_only=False) for x in asking.flatten())
                q = unit(np.stack(vectors).astype("float64"))
                far = np.sqrt(((q - sent.value[cell]) ** 2).sum(axis=1))
                reach = np.sqrt(np.maximum(0, 2 - 2 * np.where(np.isnan(kth), -1, kth))) + ROOM + 1e-6
                near = (np.maximum(far - high, low - far) <= reach) | (np.linalg.norm(q, axis=1) == 0)
                if not near.any():
                    continue
                own = batch.column(3)[n].values.to_numpy()
                block = unit(np.frombuffer(batch.column(4)[n].as_buffer()).reshape(len(own), -1))
                cosine = block @ q[near].T
                m = len(own)
                row, col = np.nonzero(cosine >= np.partition(cosine, m - k, axis=0)[m - k]) if m > k else np.nonzero(np.ones_like(cosine, bool))
                found = pd.DataFrame({"query_id": ids[near][col], "chunk_id": own[row], "similarity": cosine[row, col]})
                found = found.sort_values(["query_id", "similarity", "chunk_id"], ascending=[True, False, True]).groupby("query_id", sort=False).head(k)
                yield pa.RecordBatch.from_pandas(found, preserve_index=False)

    return joined.mapInArrow(run, "query_id bigint, chunk_id bigint, similarity double")
