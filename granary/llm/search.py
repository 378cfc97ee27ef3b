"""Ranked lexical search: best-first over document intervals, bounded by range-maximum tables.

The index holds blocks of about ``BLOCK`` words of whole documents: a row per block with its documents, its terms and one
posting list per term (document, occurrences). It is written once; nothing of it depends on the queries.

A search joins the counts of documents and words over all blocks into weights, and then answers all queries on each block:

* Documents of a block are numbered by length, so that neighbours have like impacts; a posting's impact is its share of the
  score for a weight of 1. The posting lists of the asked terms stand end to end, sorted by (term, document).
* Over the impacts lies a sparse table of range maxima (one level per power of two), another of range minima over ids.
* An interval of documents is bounded by the sum, over the query's terms, of weight times the largest impact of the term
  in the interval. The interval of the highest bound is split at the document of the term that gives most to its bound:
  that document is scored in full, both halves are bounded from the same table. ``BATCH`` intervals are split at a time.
* A block is done when no bound can reach its k-th score; at an equal bound only if the interval has a smaller id.

Each block gives at most k rows per query, and the best k of these are the answer: exact, ties included. Queries are dealt
into blocks of at most about ``QUERY_TERMS`` terms by their hash, each sent to the tasks as one bounded broadcast; all
queries meet all documents, block by block. A hot term is one list per block; copies lie side by side, and are passed over
once k of them with smaller ids are found. The index and weights are written to the shared folder.

Defined cases: null, empty and term-less texts are no documents of N and are never found; a null or term-less item has no
rows; scores of 0 are left out; rows that repeat a document's id are documents of their own; rows that repeat an item's id and text are
one item, other texts of its id are items of their own; a null id comes before others; empty tables give no rows; extra columns are ignored; a text longer than a block is a block.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from granary.session import materialize

#: Words of an index block; terms of a block of queries; intervals split together.
BLOCK, QUERY_TERMS, BATCH = 1 << 22, 1 << 17, 32
#: Stands for a null id inside the index.
NO_ID = -(1 << 63)
#: Term bytes are letters, digits and all beyond ASCII; A-Z are lower-cased.
BYTES = bytes(b | 32 if 65 <= b <= 90 else b if b > 127 or chr(b).isalnum() else 32 for b in range(256))


class Numbers(dict):
    """Numbers keys in the order in which they are met."""

    def __missing__(self, key):
        self[key] = n = len(self)
        return n


def terms_of(text: str | None) -> list[bytes]:
    return text.encode().translate(BYTES).split() if text else []


def build_index(docs: DataFrame, block_words: int = BLOCK) -> DataFrame:
    """A row per block: ids and lengths of its documents; terms, length of each term's list, and the lists end to end."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        numbers, ids, lengths, found, times, held = Numbers(), [], [], [], [], 0

        def block() -> pa.RecordBatch:
            nonlocal numbers, ids, lengths, found, times, held
            term, tf = np.concatenate(found), np.concatenate(times)
            doc = np.repeat(np.arange(len(ids), dtype=np.int32), [len(x) for x in found])
            order = np.argsort(term, kind="stable")
            row = _block_row(ids, lengths, list(numbers), np.bincount(term, minlength=len(numbers)), doc[order], tf[order])
            numbers, ids, lengths, found, times, held = Numbers(), [], [], [], [], 0
            return row

        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                words = terms_of(text)
                if not words:
                    continue
                term, tf = np.unique(np.fromiter(map(numbers.__getitem__, words), np.int32, len(words)), return_counts=True)
                ids.append(doc_id)
                lengths.append(len(words))
                found.append(term)
                times.append(tf.astype(np.int32))
                held += len(words)
                if held >= block_words:
                    yield block()
        if held:
            yield block()

    schema = "ids array<long>, lengths array<long>, terms array<string>, n_docs array<long>, doc binary, tf binary"
    return docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)), "text").mapInArrow(run, schema)


def _block_row(ids, lengths, terms, n_docs, doc, tf) -> pa.RecordBatch:
    def one(values: pa.Array) -> pa.Array:
        return pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), values)

    lists = [one(pa.array(x, pa.int64())) for x in (ids, lengths)] + [one(pa.array(terms, pa.binary()).cast(pa.string())), one(pa.array(n_docs, pa.int64()))]
    return pa.RecordBatch.from_arrays([*lists, *(pa.array([x.tobytes()], pa.binary()) for x in (doc, tf))], names=["ids", "lengths", "terms", "n_docs", "doc", "tf"])


def query_terms(items: DataFrame) -> DataFrame:
    """item_id, item (a name of id and text), term and its repeats."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k, text in enumerate(batch.column(2).to_pylist()):
                term, repeats = np.unique(np.array(terms_of(text), object), return_counts=True)
                n = len(term)
                same = [batch.column(c).take(pa.array(np.full(n, k))) for c in (0, 1)]
                yield pa.RecordBatch.from_arrays([*same, pa.array(term.tolist(), pa.binary()).cast(pa.string()), pa.array(repeats, pa.int64())], names=["item_id", "item", "term", "repeats"])

    distinct = items.select("item_id", "text").distinct()
    named = distinct.select("item_id", F.sha2(F.to_json(F.struct("item_id", "text")), 256).alias("item"), "text")
    return named.mapInArrow(run, f"item_id {items.schema['item_id'].dataType.simpleString()}, item string, term string, repeats long")


def weights(index: DataFrame, asked: DataFrame) -> tuple[DataFrame, int, int]:
    """term and w of the asked terms that documents hold; the number of documents and of all their terms."""
    whole = index.agg(F.sum(F.size("ids").cast("long")), F.sum(F.aggregate("lengths", F.lit(0).cast("long"), lambda a, x: a + x))).first()
    n, total = whole[0] or 0, whole[1] or 0
    held = index.select(F.explode(F.arrays_zip("terms", "n_docs")).alias("t")).select(F.col("t.terms").alias("term"), "t.n_docs")
    df = held.join(asked.select("term").distinct(), "term", "left_semi").groupBy("term").agg(F.sum("n_docs").alias("df"))
    return df.select("term", F.floor(1000 * F.log(F.lit(2.0 * n + 2) / (2 * F.col("df") + 1))).cast("long").alias("w")), n, total


class Block:
    """The posting lists of the asked terms in one block, ready to be searched."""

    def __init__(self, ids, lengths, lists, doc, tf, n_docs: int, total: int):
        """lists: first and last place (exclusive) of each asked term's postings in ``doc`` and ``tf``."""
        order = np.lexsort((ids, lengths))
        number = np.empty(len(ids), np.int64)
        number[order] = np.arange(len(ids))
        self.ids, self.size = ids[order], len(ids)
        m = 100 - 25 + (25 * lengths[order] * n_docs) // total
        size = lists[:, 1] - lists[:, 0]
        self.first = np.concatenate(([0], np.cumsum(size)))
        pick = np.repeat(lists[:, 0] - self.first[:-1], size) + np.arange(self.first[-1])
        term, doc = np.repeat(np.arange(len(size)), size), number[doc[pick]]
        key = term * self.size + doc
        by = np.argsort(key, kind="stable")
        self.key, self.doc, tf = key[by], doc[by], tf[pick][by].astype(np.int64)
        self.impact = (1_000_000_000 * tf) // (1000 * tf + 12 * m[self.doc])
        # sparse tables: places of the largest impacts, smallest ids
        self.top = self._levels(self.impact, int(size.max(initial=1)), np.greater_equal)
        self.low = self._levels(self.ids, self.size, np.less_equal)

    @staticmethod
    def _levels(value: np.ndarray, longest: int, better) -> np.ndarray:
        place = np.arange(len(value), dtype=np.int32)
        out, step = [place], 1
        while 2 * step <= longest:
            place = place.copy()
            a, b = out[-1][:-step], out[-1][step:]
            place[: len(a)] = np.where(better(value[a], value[b]), a, b)
            out.append(place)
            step *= 2
        return np.stack(out)

    @staticmethod
    def _extreme(levels: np.ndarray, value: np.ndarray, lo: np.ndarray, hi: np.ndarray, better) -> tuple[np.ndarray, np.ndarray]:
        """The place of the extreme value in each lo..hi; places of empty ranges mean nothing, the mask tells them."""
        full = hi > lo
        k = np.frexp(np.maximum(hi - lo, 1).astype(np.float64))[1] - 1
        last = len(value) - 1
        a = levels[k, np.minimum(lo, last)]
        b = levels[k, np.clip(hi - (1 << k), 0, last)]
        return np.where(better(value[a], value[b]), a, b), full

    def _bounds(self, lo: np.ndarray, hi: np.ndarray, w: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For intervals (columns) given by places in each term's list (rows): the bound, and the number of the document to split at."""
        place, full = self._extreme(self.top, self.impact, lo, hi, np.greater_equal)
        share = np.where(full, w[:, None] * self.impact[place], -1)
        most = share.argmax(axis=0)
        return np.maximum(share, 0).sum(axis=0), self.doc[place[most, np.arange(len(most))]]

    def search(self, terms: np.ndarray, w: np.ndarray, k: int) -> list[tuple[int, int]]:
        """The k best (score, id) above 0, highest first, equal scores by id. terms: numbers of asked terms; w: their weights."""
        best: list[tuple[int, int]] = []  # heap of (score, -id): its first is the k-th
        lo, hi = self.first[terms][:, None], self.first[terms + 1][:, None]
        base = terms[:, None] * self.size
        bound, split = self._bounds(lo, hi, w)
        queue = [(-int(bound[0]), int(self.ids.min()), 0, self.size, int(split[0]), lo[:, 0], hi[:, 0])] if bound[0] > 0 else []
        while queue:
            batch = []
            while queue and len(batch) < BATCH:
                x = queue[0]
                if len(best) == k and (-x[0] < best[0][0] or (-x[0] == best[0][0] and x[1] > -best[0][1])):
                    if -x[0] < best[0][0]:
                        queue.clear()
                        break
                    heapq.heappop(queue)
                    continue
                batch.append(heapq.heappop(queue))
            if not batch:
                break
            a, b = (np.array([x[c] for x in batch]) for c in (2, 3))
            at = np.array([x[4] for x in batch])
            lo, hi = (np.stack([x[c] for x in batch], axis=1) for c in (5, 6))
            mid = np.searchsorted(self.key, base + at)
            hit = np.take(self.key, mid, mode="clip") == base + at
            score = (w[:, None] * np.where(hit, np.take(self.impact, mid, mode="clip"), 0)).sum(axis=0)
            for s, d in zip(score.tolist(), self.ids[at].tolist(), strict=True):
                if s > 0 and (len(best) < k or (s, -d) > best[0]):
                    (heapq.heappush if len(best) < k else heapq.heapreplace)(best, (s, -d))
            # both halves
            lo, hi = np.concatenate([lo, mid + hit], axis=1), np.concatenate([mid, hi], axis=1)
            a, b = np.concatenate([a, at + 1]), np.concatenate([at, b])
            bound, split = self._bounds(lo, hi, w)
            keep = np.flatnonzero(bound > 0 if len(best) < k else bound >= max(best[0][0], 1))
            if not len(keep):
                continue
            place, _ = self._extreme(self.low, self.ids, a[keep], b[keep], np.less_equal)
            for j, least in zip(keep.tolist(), self.ids[place].tolist(), strict=True):
                heapq.heappush(queue, (-int(bound[j]), least, int(a[j]), int(b[j]), int(split[j]), lo[:, j], hi[:, j]))
        return sorted(((s, -d) for s, d in best), key=lambda x: (-x[0], x[1]))


def answer(index: DataFrame, asked: pd.DataFrame, n_docs: int, total: int, k: int) -> DataFrame:
    """item, doc_id, score: the k best documents of each block for the queries of a bounded frame of item, term and weight."""
    terms = sorted(set(asked["term"]))
    number = {t: i for i, t in enumerate(terms)}
    queries = [(item, rows["term"].map(number).to_numpy(np.int64), rows["weight"].to_numpy(np.int64)) for item, rows in asked.groupby("item")]
    sent = index.sparkSession.sparkContext.broadcast((terms, queries))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import pyarrow.compute as pc

        terms, queries = sent.value
        wanted = pa.array(terms, pa.string())
        for batch in batches:
            for r in range(batch.num_rows):
                ids, lengths, own, size = (batch.column(c)[r].values for c in range(4))
                ids, lengths, size = (x.to_numpy(zero_copy_only=False) for x in (ids, lengths, size))
                doc, tf = (np.frombuffer(batch.column(c)[r].as_buffer(), np.int32) for c in (4, 5))
                place = pc.fill_null(pc.index_in(wanted, value_set=own), -1).to_numpy(zero_copy_only=False)
                if not (place >= 0).any():
                    continue
                end = np.cumsum(size)
                lists = np.stack([np.where(place >= 0, (end - size)[place], 0), np.where(place >= 0, end[place], 0)], axis=1)
                block = Block(ids, lengths, lists, doc, tf, n_docs, total)
                found = []
                for item, t, w in queries:
                    here = place[t] >= 0
                    if here.any():
                        found += [(item, d, s) for s, d in block.search(t[here], w[here], k)]
                if found:
                    items, docs, scores = zip(*found, strict=True)
                    yield pa.RecordBatch.from_arrays([pa.array(items, pa.string()), pa.array(docs, pa.int64()), pa.array(scores, pa.int64())], names=["item", "doc_id", "score"])

    return index.mapInArrow(run, "item string, doc_id long, score long")


def search(docs: DataFrame, items: DataFrame, k: int = 20, block_words: int = BLOCK, block_terms: int = QUERY_TERMS) -> DataFrame:
    """item_id, rank, doc_id and score of each item's k best documents."""
    index = materialize(build_index(docs, block_words), "index")
    asked = materialize(query_terms(items), "asked")
    weight, n_docs, total = weights(index, asked)
    known = materialize(asked.join(weight, "term").select("item", "term", (F.col("w") * F.col("repeats")).alias("weight")).filter("weight > 0"), "known")
    parts = max(1, -(-known.count() // block_terms))
    found = [answer(index, known.filter(F.pmod(F.xxhash64("item"), F.lit(parts)) == p).toPandas(), n_docs, total, k) for p in range(parts)]
    each = materialize(reduce(DataFrame.unionAll, found), "found")
    ranked = each.withColumn("rank", F.row_number().over(Window.partitionBy("item").orderBy(F.desc("score"), "doc_id"))).filter(F.col("rank") <= k)
    named = ranked.join(asked.select("item", "item_id").distinct(), "item")
    return named.select("item_id", "rank", F.when(F.col("doc_id") != NO_ID, F.col("doc_id")).alias("doc_id"), "score")
