"""Ranking by shared words over posting lists, for any number of queries.

``build_postings`` writes the chunks once as blocks: a row holds the ids of its chunks, its words, and the chunks of each
word. ``best_by_overlap`` takes the queries in groups of bounded size; each block answers each query on the spot and passes
on at most ``k`` rows, so no row is ever made per (query, chunk) pair, however common a word is.

Inside a block a query's words are taken rarest first. After some of them, a chunk not yet met can share no more words than
are left; once ``k`` chunks share more, no new chunk can enter, and the longer lists are only looked up for those that are in.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from granary.session import materialize

#: Words (with their chunks) of a block; rows and words of a group of queries.
BLOCK_WORDS = 2_000_000
GROUP_ROWS = 16_384
GROUP_WORDS = 1_000_000

BLOCK = "chunk_type string, ids array<bigint>, words array<string>, ends array<bigint>, rows binary"
FOUND = "query_id bigint, chunk_id bigint, position int, overlap bigint"


def build_postings(chunks: DataFrame, block_words: int = BLOCK_WORDS) -> DataFrame:
    """Blocks of ``(chunk_id, chunk_type, words)``; ``words`` are the distinct words of a chunk."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return in_blocks(batches, block_words)

    return chunks.select(F.col("chunk_id").cast("long"), "chunk_type", "words").mapInArrow(run, BLOCK)


def in_blocks(batches: Iterator[pa.RecordBatch], block_words: int) -> Iterator[pa.RecordBatch]:
    """Words stay in Arrow's buffers, some ten bytes each, so a task holds a batch and a block per type, whatever its input."""
    held: dict[str, list[pa.RecordBatch]] = {}
    size: dict[str, int] = {}
    for batch in batches:
        kinds = batch.column(1).dictionary_encode("encode")
        number = kinds.indices.to_numpy()
        length = _lengths(batch.column(2))
        for n, kind in enumerate(kinds.dictionary.to_pylist()):
            mine = np.flatnonzero((number == n) & (length > 0))
            total = np.cumsum(length[mine], dtype=np.int64) + size.get(kind, 0)
            while len(mine):
                end = int(np.searchsorted(total, block_words)) + 1  # the chunk that fills the block is its last
                held.setdefault(kind, []).append(batch.take(pa.array(mine[:end])))
                size[kind] = int(total[:end][-1])
                if size[kind] >= block_words:
                    yield _block(kind, held.pop(kind))
                    size[kind] = 0
                    total = total - total[end - 1]
                mine, total = mine[end:], total[end:]
    while held:
        yield _block(*held.popitem())


def _lengths(lists: pa.Array) -> np.ndarray:
    import pyarrow.compute as pc

    return pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False)


def _block(kind: str, parts: list[pa.RecordBatch]) -> pa.RecordBatch:
    chunks = pa.Table.from_batches(parts).select([0, 2]).combine_chunks().to_batches()[0]
    parts.clear()
    order = np.argsort(chunks.column(0).to_numpy(), kind="stable")  # a smaller number in the block is a smaller id
    if (order[1:] < order[:-1]).any():
        chunks = chunks.take(pa.array(order))
    words = chunks.column(1).flatten().dictionary_encode()
    row = np.repeat(np.arange(len(chunks), dtype=np.int32), _lengths(chunks.column(1)))
    code = words.indices.to_numpy()
    order = np.argsort(code, kind="stable")
    ends = np.cumsum(np.bincount(code, minlength=len(words.dictionary)))

    def one(values: pa.Array) -> pa.Array:
        return pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), values)

    columns = [pa.array([kind], pa.string()), one(chunks.column(0)), one(words.dictionary), one(pa.array(ends, pa.int64()))]
    columns += [pa.array([row[order].tobytes()], pa.binary())]
    return pa.RecordBatch.from_arrays(columns, names=["chunk_type", "ids", "words", "ends", "rows"])


def most_shared(lists: list[np.ndarray], k: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``k`` numbers that stand in most of the sorted ``lists``, ties by number, and in how many they stand."""
    lists = sorted(lists, key=len)
    met, count = lists[0], np.ones(len(lists[0]), np.int64)
    taken = 1
    while taken < len(lists):
        if len(met) >= k and np.partition(count, -k)[-k] > len(lists) - taken:
            break  # a number not yet met cannot come in
        both = np.concatenate([met, lists[taken]])
        met, place = np.unique(both, return_inverse=True)
        count = np.bincount(place, np.concatenate([count, np.ones(len(lists[taken]), np.int64)])).astype(np.int64)
        taken += 1
    for j in range(taken, len(lists)):
        least = np.partition(count, -k)[-k]
        open_ = count + len(lists) - j >= least  # the others have fallen out
        met, count = met[open_], count[open_]
        at = np.searchsorted(lists[j], met)
        count = count + (np.take(lists[j], at, mode="clip") == met)
    best = np.lexsort((met, -count))[:k]
    return met[best], count[best]


def best_by_overlap(blocks: DataFrame, asked: DataFrame, k: int, group_rows: int = GROUP_ROWS, group_words: int = GROUP_WORDS) -> DataFrame:
    """The ``k`` best chunks of each block for each row of ``(query_id, chunk_type, position, words)``."""
    asked = asked.filter(F.size("words") > 0)
    size = asked.agg(F.count(F.lit(1)).alias("rows"), F.sum(F.size("words")).alias("words")).first()
    groups = max(1, -(-size["rows"] // group_rows), -(-(size["words"] or 0) // group_words))
    group = F.pmod(F.xxhash64("query_id"), F.lit(groups))
    found = [_answer(blocks, asked.filter(group == g), k) for g in range(groups)]
    return reduce(DataFrame.unionAll, found)


def _answer(blocks: DataFrame, asked: DataFrame, k: int) -> DataFrame:
    rows = asked.collect()  # a group of bounded size
    by_type: dict[str, tuple[list[str], list]] = {}
    for kind in {r["chunk_type"] for r in rows}:
        mine = [r for r in rows if r["chunk_type"] == kind]
        words = sorted({w for r in mine for w in r["words"]})
        number = {w: n for n, w in enumerate(words)}
        by_type[kind] = words, [(r["query_id"], r["position"], np.array([number[w] for w in r["words"]])) for r in mine]
    sent = blocks.sparkSession.sparkContext.broadcast(by_type)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import pyarrow.compute as pc

        for batch in batches:
            for n in range(batch.num_rows):
                words, queries = sent.value.get(batch.column(0)[n].as_py(), ((), ()))
                if not queries:
                    continue
                ids, own, ends = (batch.column(c)[n].values for c in (1, 2, 3))
                place = pc.fill_null(pc.index_in(pa.array(words, pa.string()), value_set=own), -1).to_numpy(zero_copy_only=False)
                ids, ends = ids.to_numpy(), np.concatenate(([0], ends.to_numpy()))
                of_word = np.frombuffer(batch.column(4)[n].as_buffer(), np.int32)
                out = []
                for query, position, wanted in queries:
                    here = place[wanted]
                    lists = [of_word[ends[w] : ends[w + 1]] for w in here[here >= 0]]
                    if lists:
                        met, count = most_shared(lists, k)
                        out.append((np.full(len(met), query), ids[met], np.full(len(met), position), count))
                if out:
                    parts = [np.concatenate(x) for x in zip(*out, strict=True)]
                    kinds = (pa.int64(), pa.int64(), pa.int32(), pa.int64())
                    yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(parts, kinds, strict=True)], names=["query_id", "chunk_id", "position", "overlap"])

    return blocks.mapInArrow(run, FOUND)


def word_blocks(chunks: DataFrame, words) -> DataFrame:
    """Written posting blocks of ``(chunk_id, chunk_type, content)``; ``words`` is the column of a chunk's distinct words."""
    return materialize(build_postings(chunks.select("chunk_id", "chunk_type", words.alias("words"))), "postings")
