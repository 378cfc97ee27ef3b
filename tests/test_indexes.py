"""Posting lists and the vector index against plain comparison of all pairs."""

import random
import tracemalloc
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest

from granary.operators import postings, retrieval, vectors


def test_most_shared_against_counting():
    rng = random.Random(1)
    for _ in range(400):
        lists = [np.array(sorted(rng.sample(range(60), rng.choice([1, 3, 20, 60])))) for _ in range(rng.randint(1, 9))]
        k = rng.randint(1, 8)
        count = np.bincount(np.concatenate(lists), minlength=60)
        want = sorted((n for n in range(60) if count[n]), key=lambda n: (-count[n], n))[:k]
        met, found = postings.most_shared(lists, k)
        assert met.tolist() == want and found.tolist() == count[want].tolist()


def test_common_lists_bring_in_no_new_chunks(monkeypatch):
    """Three rare words shared by five chunks: the list of a common word is only looked up."""
    rare, common = np.arange(5), np.arange(1_000_000)
    sizes, real = [], np.unique
    monkeypatch.setattr(np, "unique", lambda x, **kw: sizes.append(len(x)) or real(x, **kw))
    met, found = postings.most_shared([common, rare, rare, rare, common], 5)
    assert met.tolist() == [0, 1, 2, 3, 4] and set(found) == {5} and max(sizes) <= 10


def test_postings_hold_no_python_object_per_word():
    def batches():
        for b in range(10):
            words = [[f"word{(31 * j + i) % 5000}" for i in range(200)] for j in range(100)]
            yield pa.RecordBatch.from_pydict({"chunk_id": list(range(100 * b, 100 * b + 100)), "chunk_type": ["a", None] * 50, "words": words})

    ready = list(batches())
    tracemalloc.start()
    blocks = list(postings.in_blocks(iter(ready), 60_000))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert sorted((b.column(0)[0].as_py() or "", len(b.column(1)[0])) for b in blocks) == [("", 200), ("", 300), ("a", 200), ("a", 300)]
    assert peak < 30 * 200_000  # a word as a Python object takes some 60 bytes


@pytest.mark.parametrize("block_words", [1, 200, 2_000_000])
def test_many_queries_equal_their_groups(spark, block_words):
    rng = random.Random(3)
    words = [f"w{j}" for j in range(50)]
    chunks = [(j, rng.choice(["contract", "manifest"]), " ".join(["the", *rng.choices(words, k=rng.randrange(9))])) for j in range(300)]
    queries = [(j, "the " + " ".join(rng.choices(words, k=4))) for j in range(2000)]
    q = spark.createDataFrame(queries, "query_id long, query string").select("query_id", "query")
    c = spark.createDataFrame(chunks, "chunk_id long, chunk_type string, content string").repartition(3)
    blocks = postings.build_postings(c.select("chunk_id", "chunk_type", retrieval.word_set("content").alias("words")), block_words)
    asked = retrieval.route_queries(q).select("query_id", "chunk_type", "position", retrieval.word_set("query").alias("words"))
    one = sorted(map(tuple, postings.best_by_overlap(blocks, asked, 3).distinct().collect()))
    many = sorted(map(tuple, postings.best_by_overlap(blocks, asked, 3, group_rows=500).distinct().collect()))
    assert one == many and len({r[0] for r in one}) == 2000
    text = {cid: set(t.split()) for cid, _, t in chunks}
    asked_words = {qid: set(t.split()) for qid, t in queries}
    assert all(len(text[cid] & asked_words[qid]) == n for qid, cid, _, n in one[:3000])


@pytest.mark.parametrize(("cells", "block_rows", "group_rows"), [(1, 7, 3), (12, 8, 1024), (40, 4096, 5)])
def test_vector_index_is_exact(spark, cells, block_rows, group_rows):
    rng = np.random.default_rng(cells)
    middle = rng.normal(size=(10, 6)) * 4
    vecs = (middle[rng.integers(10, size=500)] + rng.normal(size=(500, 6))).round(2)
    vecs[10] = vecs[11] = vecs[12]
    vecs[20] = vecs[21] = 0
    asks = np.vstack([vecs[12], vecs[20], -middle[0], vecs[::60], rng.normal(size=(6, 6))])
    c = spark.createDataFrame([(j, v.tolist()) for j, v in enumerate(vecs)] + [(900, None)], "chunk_id long, embedding array<float>").repartition(4)
    q = spark.createDataFrame([(j, v.tolist()) for j, v in enumerate(asks)], "query_id long, embedding array<double>")
    index = vectors.build(c, cells=cells, block_rows=block_rows)
    got = defaultdict(list)
    for r in vectors.search(index, q, 6, group_rows).orderBy("query_id", "rank").collect():
        got[r["query_id"]].append(r["chunk_id"])
    single = vecs.astype("float32").astype("float64")
    norm = np.linalg.norm(single, axis=1)
    for j, a in enumerate(asks):
        length = norm * np.linalg.norm(a)
        sim = np.divide(single @ a, length, out=np.zeros(500), where=length > 0).round(12)
        want = sorted(range(500), key=lambda n: (-sim[n], n))[:6]
        assert sorted(sim[got[j]]) == sorted(sim[want]) and len(set(got[j])) == 6
    if cells == 12:
        assert vectors.share_read(index, q.filter("query_id > 2 and query_id < 11"), 6) < 0.6


def test_vector_index_of_few_or_no_vectors(spark):
    some = spark.createDataFrame([(1, [1.0, 0.0]), (2, [0.0, 1.0])], "chunk_id long, embedding array<double>")
    asked = spark.createDataFrame([(5, [1.0, 0.1]), (6, None)], "query_id long, embedding array<double>")
    assert [(r.query_id, r.chunk_id, r["rank"]) for r in vectors.search(vectors.build(some), asked, 3).orderBy("rank").collect()] == [(5, 1, 1), (5, 2, 2)]
    assert vectors.search(vectors.build(some.limit(0)), asked, 3).count() == 0
    assert vectors.search(vectors.build(some), asked.limit(0), 3).count() == 0
