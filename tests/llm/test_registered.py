"""The registered queries of this folder on the given tables, against their SQL or the plain versions."""

import os
import re
import zlib
from collections import Counter, defaultdict

import brute
import public_tokenizers
import pytest

import __spark_entry__ as entry_points
import corpus_pipeline
from granary.llm import bpe, pii, queries
from granary.session import materialize
from tools.check import compare, duck

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="test tables not present")


def rows(spark, name):
    return entry_points.queries()[name](spark, FOLDER).collect()


@pytest.fixture(scope="module")
def texts(spark):
    return {r.doc_id: r.text for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect()}


def test_one_query_per_operator():
    assert sorted(int(re.match(r"op(\d+)_", q)[1]) for q in queries.QUERIES) == list(range(1, 14))
    assert "pipeline" in entry_points.queries()


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_against_sql(spark, name):
    assert compare(spark, duck(FOLDER), name, FOLDER).startswith("ok")


def test_personal_data(spark, texts):
    got = rows(spark, "op4_pii")
    assert len(got) == len(texts)
    for r in got:
        base = brute.pii(texts[r.doc_id])
        assert r.base_sha256 == brute.sha(",".join(base)) and set(base) <= set(r.spans.split(","))
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(b.startswith(k + ":") for b in base) for k in brute.KINDS]


def test_pages_give_their_articles(spark):
    import html

    got = {r.page_id: r for r in rows(spark, "op5_html_text")}
    for r in spark.read.parquet(f"{FOLDER}/pages.parquet").collect():
        article = re.search(r"<article>(.*?)</article>", r.html, re.S)[1]
        blocks = (re.sub(r"\s+", " ", html.unescape(re.sub(r"</?b>|<br>", " ", x))).strip() for x in re.split(r"</?(?:p|h1)>", article))
        assert got[r.page_id].text.split() == "\n".join(b for b in blocks if b).split()
        assert got[r.page_id].n_chars == len(got[r.page_id].text)


def test_packing(spark, texts):
    from tokenizers import Tokenizer

    known = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    got = rows(spark, "op7_best_fit")
    pieces, places = defaultdict(dict), defaultdict(list)
    for r in got:
        pieces[r.doc_id][r.piece] = r
        places[r.sequence_id].append((r.offset, r.length))
    for d, t in texts.items():
        ids, at = [*known.encode(t or "", add_special_tokens=False).ids, 0], 0
        for k in range(len(pieces[d])):
            p = pieces[d][k]
            assert p.start == at and p.ids_crc32 == zlib.crc32(b"".join(i.to_bytes(4, "little") for i in ids[at : at + p.length]))
            at += p.length
        assert at == len(ids)
    for p in places.values():
        assert sum(n for _, n in p) <= 2048 and [o for o, _ in sorted(p)] == [sum(n for _, n in sorted(p)[:k]) for k in range(len(p))]
    assert len(places) <= 1.03 * sum(r.length for r in got) / 2048 + 1


def test_quality_rules(spark, texts):
    got = rows(spark, "op8_quality_rules")
    for r in got:
        assert brute.quality(texts[r.doc_id]) == (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed)
        assert not (r.kept and r.base_failed)


def test_quality_scores_on_held_out_rows(spark):
    folder = "/root/testdata/sf0.1"
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{folder}/labels.parquet").collect()}
    got = entry_points.queries()["op9_quality_rank"](spark, folder).collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) and 0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in got)
    seen = [(r.predicted, labels[r.doc_id]) for r in got if r.held_out and r.doc_id in labels]
    assert sum(a == b for a, b in seen) > 0.97 * len(seen)
    for kind in (0, 1):
        mine = [a for a, b in seen if b == kind]
        assert sum(a == kind for a in mine) > 0.9 * len(mine)


def test_pipeline_stages(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{FOLDER}/benchmark.parquet").collect()]
    before = {r.doc_id: r for r in docs.collect()}
    now = docs
    for name, stage in corpus_pipeline.STAGES:
        now = materialize(stage(spark, now, FOLDER), name)
        if name == "best_fit_packing":
            break
        assert now.schema.names == docs.schema.names
        after = {r.doc_id: r for r in now.collect()}
        pairs = [(k, r.text) for k, r in before.items()]
        if name == "quality_rules":
            assert not [k for k in after if brute.quality(after[k].text)[-1]] and set(after) < set(before)
        elif name == "ngram_jaccard_join":
            assert set(after) == {k for k, (_, c) in brute.components(pairs, 5, 80).items() if c == k}
        elif name == "decontamination":
            assert set(after) == {k for k, w in brute.decontaminate(pairs, items).items() if not w[4]}
        elif name == "pii":
            assert set(after) == set(before) and not any(brute.pii(r.text) for r in after.values())
            assert all(r.n_chars == len(r.text) for r in after.values())
        if name != "pii":
            assert all(after[k] == before[k] for k in after)
        before = after
    got = now.collect()
    assert {r.doc_id for r in got} == set(before)
    whole = Counter()
    for r in got:
        whole[r.sequence_id] += r.length
    assert max(whole.values()) <= 2048
    assert sorted(map(tuple, corpus_pipeline.run(spark, FOLDER).select("doc_id", "piece", "ids_crc32").collect())) == sorted((r.doc_id, r.piece, r.ids_crc32) for r in got)


def test_kinds_are_named_once():
    assert len(set(pii.KINDS)) == len(pii.KINDS) and pii.KINDS[:4] == brute.KINDS


def test_byte_bpe(spark, texts):
    import tiktoken

    known = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.read_ranks(public_tokenizers.path("byte_bpe_multi_50k.tiktoken")), special_tokens={})
    got = rows(spark, "op12_byte_bpe")
    assert sorted(r.doc_id for r in got) == sorted(texts)
    for r in got:
        t = texts[r.doc_id] or ""
        ids = known.encode_ordinary(t)
        assert (r.n_tokens, r.ids_sha256, r.decoded_sha256) == (len(ids), brute.sha(",".join(map(str, ids))), brute.sha(t))
