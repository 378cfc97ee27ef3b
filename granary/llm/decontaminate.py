"""Benchmark decontamination by winnowing.

Every run of ``K`` words has a hash. Of each window of ``SPAN`` words the run with the least hash (the first of equals) is
kept, in documents and benchmark alike, so every shared span of ``SPAN`` words shares a kept run at the same place. Kept
runs are joined on their hash; each hit is extended left and right over the words around it, compared as words, and counts
if the shared span reaches ``SPAN`` words. An item of fewer words is one run of all its words.

The benchmark's hashes also set bits of a bitmap of fixed size. It only spares documents' runs the join that cannot hit
anything; when a very large benchmark fills it, all runs go to the join.

Defined cases: null texts have no words; a benchmark row without words or without an id is no item; documents with equal
id and text count once; documents without a hit, and every document when the benchmark is empty, have no spans and items.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from granary.llm.text import ALNUM, Words, slabs
from granary.session import materialize

K, SPAN = 5, 10
SLOTS = 23  # the bitmap has 2**SLOTS bits
CONTEXT = "hash long, k int, words array<string>, before int"


def kept_runs(words: Words) -> np.ndarray:
    """First words of the kept runs of K words."""
    hashes, _ = words.grams(K)
    n = len(words.hash) - SPAN + 1
    if n <= 0:
        return np.zeros(0, np.int64)
    window = np.flatnonzero(words.doc[:n] == words.doc[SPAN - 1 :])
    least = np.lib.stride_tricks.sliding_window_view(hashes, SPAN - K + 1)[window].argmin(axis=1)
    return np.unique(window + least)


def context(words: Words, at: int, k: int, around: int) -> tuple[list[str], int]:
    """The words of a run with up to ``around`` more of its text on each side, and how many come before the run."""
    doc = words.doc[at]
    lo, hi = max(at - around, words.first[doc]), min(at + k + around, words.first[doc + 1])
    return words.words(lo, hi).split(" "), at - lo


def benchmark_runs(benchmark: DataFrame) -> DataFrame:
    """Distinct kept runs of the benchmark with their surroundings and the sorted ids of the items they stand in."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            items = batch.column(batch.schema.get_field_index("item_id"))
            out: list[tuple] = []
            for first, texts in slabs(batch, "text"):
                words = Words(texts, ALNUM)
                hashes, _ = words.grams(K)
                out += [(first + int(words.doc[p]), int(hashes[p].view(np.int64)), K, *context(words, p, K, SPAN - K)) for p in kept_runs(words)]
                sizes = np.diff(words.first)
                for k in np.unique(sizes[(sizes > 0) & (sizes < SPAN)]):
                    hashes, _ = words.grams(int(k))
                    for d in np.flatnonzero(sizes == k):
                        p = words.first[d]
                        out.append((first + int(d), int(hashes[p].view(np.int64)), -int(k), *context(words, p, int(k), 0)))
            rows, h, k, w, before = zip(*out, strict=True) if out else ([],) * 5
            yield pa.RecordBatch.from_arrays(
                [items.take(pa.array(rows, pa.int64())), pa.array(h, pa.int64()), pa.array(k, pa.int32()), pa.array(w, pa.list_(pa.string())), pa.array(before, pa.int32())],
                names=["item_id", "hash", "k", "words", "before"],
            )

    kind = benchmark.schema["item_id"].dataType.simpleString()
    found = benchmark.where(F.col("item_id").isNotNull()).select("item_id", "text").mapInArrow(run, f"item_id {kind}, {CONTEXT}")
    return found.groupBy("hash", "k", "words", "before").agg(F.sort_array(F.collect_set("item_id")).alias("items"))


def bitmap(runs: DataFrame) -> np.ndarray:
    """2**SLOTS bits, one set for each hash: 1 MB on the driver whatever the size of the benchmark."""
    slot = F.expr(f"shiftrightunsigned(hash, {64 - SLOTS}) + 1")  # buckets count from 1
    rows = runs.select(slot.alias("s")).groupBy(F.bitmap_bucket_number("s").alias("b")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("s")).alias("bits"))
    out = np.zeros((1 << SLOTS) // 8, np.uint8)
    for r in rows.collect():
        out[(r["b"] - 1) * 4096 : r["b"] * 4096] = np.frombuffer(bytes(r["bits"]), np.uint8)
    return out


def _span(words: list[str], before: int, item: list[str], item_before: int, k: int) -> tuple[int, int]:
    """Shared words left of the run, and from its start on; 0, 0 if the runs differ."""
    if words[before : before + k] != item[item_before : item_before + k]:
        return 0, 0
    left = 0
    while left < min(before, item_before) and words[before - left - 1] == item[item_before - left - 1]:
        left += 1
    right = k
    while before + right < len(words) and item_before + right < len(item) and words[before + right] == item[item_before + right]:
        right += 1
    return left, right


def find_hits(documents: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Per document (``doc_id`` and ``text_hash``): ``n_words``, ``spans`` of hit words (start, end; disjoint, sorted) and
    the sorted ids of the ``items`` that occur.
    """
    runs = materialize(benchmark_runs(benchmark), "benchmark-runs")
    bits = bitmap(runs)
    short = sorted(-r["k"] for r in runs.where("k < 0").select("k").distinct().collect())  # SPAN - 1 sizes at most

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def known(hashes: np.ndarray) -> np.ndarray:
            slot = hashes >> np.uint64(64 - SLOTS)
            return (bits[slot >> np.uint64(3)] >> (slot & np.uint64(7)).astype(np.uint8)) & 1 == 1

        for batch in batches:
            for first, texts in slabs(batch, "text"):
                words = Words(texts, ALNUM)
                hashes, _ = words.grams(K)
                at = kept_runs(words)
                at = at[known(hashes[at])]
                out = [(int(words.doc[p]), int(p - words.first[words.doc[p]]), int(hashes[p].view(np.int64)), K, *context(words, p, K, SPAN - K)) for p in at]
                for k in short:
                    hashes, whole = words.grams(k)
                    for p in np.flatnonzero(whole & known(hashes)):
                        d = words.doc[p]
                        out.append((int(d), int(p - words.first[d]), int(hashes[p].view(np.int64)), -k, *context(words, p, k, 0)))
                n = len(texts)  # and one row for each document, whose hash meets none
                spread = (np.arange(n) + first).tolist()
                rows, pos, h, k_, w, before = zip(*out, *((d, 0, s, 0, None, 0) for d, s in enumerate(spread)), strict=True)
                rows = np.array(rows)
                of = pa.array(rows + first)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").take(of), batch.column("text_hash").take(of), pa.array(np.diff(words.first)[rows], pa.int64()), pa.array(pos, pa.int64()),
                     pa.array(h, pa.int64()), pa.array(k_, pa.int32()), pa.array(w, pa.list_(pa.string())), pa.array(before, pa.int32())],
                    names=["doc_id", "text_hash", "n_words", "at", "hash", "k", "words", "before"],
                )

    def extend(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lo, hi = [], []
            columns = ("at", "k", "words", "before", "item_words", "item_before")
            for at, k, words, before, item, item_before in zip(*(batch.column(c).to_pylist() for c in columns), strict=True):
                left, right = _span(words, before, item, item_before, abs(k)) if item is not None and words is not None else (0, 0)
                enough = right > 0 and left + right >= (SPAN if k > 0 else -k)
                lo.append(at - left if enough else None)
                hi.append(at + right if enough else None)
            kept = [batch.column(c) for c in ("doc_id", "text_hash", "n_words", "items")]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(lo, pa.int64()), pa.array(hi, pa.int64())], names=["doc_id", "text_hash", "n_words", "items", "lo", "hi"])

    kind = documents.schema["doc_id"].dataType.simpleString()
    item = runs.schema["items"].dataType.simpleString()
    mine = documents.select("doc_id", "text", F.xxhash64(F.coalesce("text", F.lit(""))).alias("text_hash"))
    found = mine.mapInArrow(scan, f"doc_id {kind}, text_hash long, n_words long, at long, {CONTEXT}")
    theirs = runs.select("hash", "k", F.col("words").alias("item_words"), F.col("before").alias("item_before"), "items")
    spans = found.join(theirs, ["hash", "k"], "left").mapInArrow(extend, f"doc_id {kind}, text_hash long, n_words long, items {item}, lo long, hi long")
    hit = F.when(F.col("lo").isNotNull(), F.struct("lo", "hi"))
    got = spans.groupBy("doc_id", "text_hash").agg(
        F.max("n_words").alias("n_words"),
        F.sort_array(F.collect_set(hit)).alias("hits"),
        F.sort_array(F.array_distinct(F.flatten(F.collect_set(F.when(F.col("lo").isNotNull(), F.col("items")))))).alias("items"),
    )
    start = F.array().cast("array<struct<start:long,end:long>>")

    def merge(acc, x):
        last = F.element_at(acc, -1)
        joins = (F.size(acc) > 0) & (F.when(F.size(acc) > 0, last["end"]).otherwise(F.lit(-1)) >= x["lo"])
        grown = F.struct(last["start"].alias("start"), F.greatest(last["end"], x["hi"]).alias("end"))
        alone = F.struct(x["lo"].alias("start"), x["hi"].alias("end"))
        return F.when(joins, F.concat(F.slice(acc, 1, F.size(acc) - 1), F.array(grown))).otherwise(F.concat(acc, F.array(alone)))

    return got.select("doc_id", "text_hash", "n_words", F.aggregate("hits", start, merge).alias("spans"), "items")


def drop_contaminated(documents: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Documents in which no benchmark window occurs, unchanged, whatever their other columns are called."""
    hits = find_hits(documents, benchmark).where(F.size("spans") > 0).select("doc_id", "text_hash")
    rows = documents.select(F.struct("*").alias("row"), F.col("doc_id").alias("own_id"), F.xxhash64(F.coalesce("text", F.lit(""))).alias("own_hash"))
    same = F.col("own_id").eqNullSafe(F.col("doc_id")) & (F.col("own_hash") == F.col("text_hash"))
    return rows.join(hits, same, "left_anti").select("row.*")
