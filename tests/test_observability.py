"""Drift, lineage, triage, retrieval and metrics."""

import random
from datetime import datetime

import numpy as np
import pytest
from pyspark.sql import functions as F

from granary.operators import drift, lineage, metrics, retrieval, triage
from granary.sources import catalog, contracts

SNAP = "table_name string, column_name string, data_type string, nullable boolean"
BASE = [("t", "id", "string", False), ("t", "name", "string", True), ("t", "n", "int", True)]


def drifted(spark, actual, expected=BASE):
    return drift.compare(spark.createDataFrame(expected, SNAP), spark.createDataFrame(actual, SNAP))


@pytest.mark.parametrize(
    "actual,kinds,severity",
    [
        (BASE, [], "INFO"),
        ([*BASE, ("t", "loyalty_points", "int", True)], ["COLUMN_ADDED"], "WARNING"),
        (BASE[:2], ["COLUMN_REMOVED"], "ERROR"),
        ([*BASE[:2], ("t", "n", "bigint", True)], ["TYPE_CHANGED"], "ERROR"),
        ([*BASE[:2], ("t", "n", "int", False)], ["NULLABLE_CHANGED"], "ERROR"),
        ([("t", "id", "string", True), *BASE[1:]], ["NULLABLE_CHANGED"], "WARNING"),
        ([*BASE[:2], ("t", "n", "bigint", False)], ["NULLABLE_CHANGED", "TYPE_CHANGED"], "ERROR"),
    ],
)
def test_drift(spark, actual, kinds, severity):
    changes = drifted(spark, actual)
    assert sorted(r["change_type"] for r in changes.collect()) == kinds
    down = spark.createDataFrame([("t", "stg_t"), ("t", "fact")], "table_name string, dependent string")
    row = drift.report(changes, spark.createDataFrame([("t",)], "table_name string"), down).first()
    assert row["severity"] == severity and row["requires_human_approval"]
    assert row["affected_downstream"] == ([] if not kinds else ["fact", "stg_t"])
    assert row["breaking_change"] == (severity == "ERROR")


def test_report_names_every_dependent(spark):
    names = [f"order:{n}" for n in range(3000)]
    down = spark.createDataFrame([("t", n) for n in [*names, *names[:50]]], "table_name string, dependent string")
    row = drift.report(drifted(spark, BASE[:2]), spark.createDataFrame([("t",)], "table_name string"), down).first()
    assert row["affected_downstream"] == sorted(names) and row["downstream_count"] == 3000


def test_snapshots_of_frames(spark):
    a = catalog.snapshot_of(spark, {"t": spark.range(1)})
    assert [tuple(r) for r in a.collect()] == [("t", "id", "bigint", False)]
    expected = contracts.fields_table(spark)
    products = spark.createDataFrame([], contracts.PRODUCTS.schema())
    changes = drift.compare(expected.filter("table_name = 'products'"), catalog.snapshot_of(spark, {"products": products}))
    assert changes.count() == 0
    spark.range(2).createOrReplaceTempView("snap_view")
    assert catalog.snapshot_of_catalog(spark, ["snap_view"]).first()["column_name"] == "id"


def test_platform_lineage(spark):
    edges = lineage.platform_edges(spark)
    roots = spark.createDataFrame([("bronze.customers",), ("dashboards",)], "root string")
    reached = lineage.downstream(edges, roots)
    got = {(r["root"], r["node"]): r["depth"] for r in reached.collect()}
    assert got == {
        ("bronze.customers", "silver.stg_customers"): 1,
        ("bronze.customers", "gold.dim_customer"): 2,
        ("bronze.customers", "gold.fact_sales"): 3,
        ("bronze.customers", "bi"): 3,
        ("bronze.customers", "dashboards"): 4,
    }
    rated = {r["root"]: (r["direct"], r["indirect"], r["severity"]) for r in lineage.impact(reached, roots).collect()}
    assert rated == {"bronze.customers": (1, 4, "HIGH"), "dashboards": (0, 0, "CRITICAL")}
    up = lineage.upstream(edges, spark.createDataFrame([("silver.stg_orders",)], "root string"))
    assert {r["node"]: r["depth"] for r in up.collect()} == {"bronze.orders": 1, "sqlserver": 2}


def test_lineage_with_cycles_and_a_hub(spark):
    pairs = [("a", "b"), ("b", "c"), ("c", "a"), ("a", "a")] + [("c", f"leaf{j}") for j in range(200)]
    edges = spark.createDataFrame(pairs, "src string, dst string")
    out = lineage.closure(edges, spark.createDataFrame([("a",)], "root string"))
    got = {r["node"]: r["depth"] for r in out.collect()}
    assert got["b"] == 1 and got["c"] == 2 and got["leaf7"] == 3 and len(got) == 202 and "a" not in got


def test_lineage_of_many_levels(spark):
    edges = spark.createDataFrame([(f"t{j}", f"t{j + 1}") for j in range(150)], "src string, dst string").coalesce(1)
    out = lineage.closure(edges, spark.createDataFrame([("t0",)], "root string"))
    assert out.agg({"depth": "max"}).first()[0] == 150


LOGS = [
    (1, "Cannot resolve column 'loyalty_points'", "SchemaDrift"),
    (2, "Connection refused after 30 s", "ConnectionFailure"),
    (3, "Connection refused after 45 s", "ConnectionFailure"),
    (4, "NULL in key", "DataQuality"),
    (5, "Disk full", "Unknown"),
    (6, "null value in column x", "SchemaDrift"),
]


def test_triage(spark):
    df = spark.createDataFrame([r[:2] for r in LOGS], "log_id long, text string")
    got = {r["log_id"]: r["error_type"] for r in triage.triage(df).collect()}
    assert got == {r[0]: r[2] for r in LOGS}
    groups = {r["signature"]: (r["occurrences"], r["first_id"], r["business_impact"]) for r in triage.error_groups(df).collect()}
    assert groups["connection refused after <n> s"] == (2, 2, "HIGH") and len(groups) == 5
    batch = {r["log_id"]: (r["error_type"], r["occurrences"], r["confidence_score"]) for r in triage.triage_batch(df).collect()}
    assert batch[3] == ("ConnectionFailure", 2, 0.90) and len(batch) == 6


@pytest.mark.parametrize(
    "text,kind",
    [
        ("Why did it FAIL on type x", "error_analysis"),
        ("which column type", "schema_question"),
        ("upstream of t", "lineage_question"),
        ("what is t", "documentation"),
        ("hello", "general"),
    ],
)
def test_classify(spark, text, kind):
    assert spark.createDataFrame([(text,)], "q string").select(retrieval.classify("q")).first()[0] == kind


def brute_keyword(queries, chunks, k):
    out = {}
    for qid, q in queries:
        words = set(q.lower().split())
        kinds = retrieval.ROUTES["error_analysis" if "error" in q else "general"]
        pool = [(len(words & set(c.lower().split())), kinds.index(t), cid) for cid, t, _, c in chunks if t in kinds]
        ranked = sorted(pool, key=lambda r: (-r[0], r[1], r[2]))[:k]
        out[qid] = [(cid, min(n / max(len(words), 1), 1.0)) for n, _, cid in ranked]
    return out


@pytest.mark.parametrize("block", [1000, 2])
def test_rank_keyword_against_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(retrieval, "PIECE_ROWS", 50)
    rng = random.Random(4)
    words = [f"w{j}" for j in range(30)]
    kinds = ["contract", "manifest", "error_pattern"]
    chunks = [(j, rng.choice(kinds), "s", " ".join(rng.choices(words, k=rng.randrange(0, 12)))) for j in range(120)]
    queries = [(j, " ".join(rng.choices(words, k=6)) + rng.choice(["", " error", " zzz"])) for j in range(12)]
    queries += [(90, ""), (91, "nothing shared"), (92, "W1\t w2\n\n w1")]
    q = spark.createDataFrame(queries, "query_id long, query string")
    c = spark.createDataFrame(chunks, "chunk_id long, chunk_type string, source string, content string").repartition(3)
    out = retrieval.rank_keyword(q, c, 4, block=block)
    got = {}
    for r in out.orderBy("query_id", "rank").collect():
        got.setdefault(r["query_id"], []).append((r["chunk_id"], r["score"]))
    assert got == brute_keyword(queries, chunks, 4)


def test_context(spark):
    c = spark.createDataFrame(
        [(1, "contract", "s1", "alpha beta"), (2, "manifest", "s2", "alpha"), (3, "error_pattern", "s3", "alpha")],
        "chunk_id long, chunk_type string, source string, content string",
    )
    q = spark.createDataFrame([(7, "alpha beta")], "query_id long, query string")
    row = retrieval.build_context(retrieval.rank_keyword(q, c), c).first()
    assert row["chunks"] == 2 and row["estimated_tokens"] == 3
    assert row["context"] == "[1] Source: s1\nType: contract\nContent:\nalpha beta\n\n---\n[2] Source: s2\nType: manifest\nContent:\nalpha\n"


@pytest.mark.parametrize("block", [100, 3])
def test_rank_embedding_against_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(retrieval, "PIECE_ROWS", 40)
    rng = np.random.default_rng(2)
    vecs = rng.normal(size=(60, 8)).round(1)
    vecs[10] = vecs[11] = vecs[12]
    vecs[20] = 0
    asks = np.vstack([vecs[12], rng.normal(size=(6, 8))])
    c = spark.createDataFrame([(j, v.tolist()) for j, v in enumerate(vecs)], "chunk_id long, embedding array<double>").repartition(3)
    q = spark.createDataFrame([(j, v.tolist()) for j, v in enumerate(asks)], "query_id long, embedding array<double>")
    got = {}
    for r in retrieval.rank_embedding(q, c, 4, block=block).orderBy("query_id", "rank").collect():
        got.setdefault(r["query_id"], []).append(r["chunk_id"])
    norm = np.linalg.norm(vecs, axis=1)
    for j, a in enumerate(asks):
        sim = np.divide(vecs @ a, norm * np.linalg.norm(a), out=np.zeros(60), where=norm > 0).round(12)
        assert got[j] == sorted(range(60), key=lambda n: (-sim[n], n))[:4]


CALLS = (
    "call_id string, timestamp timestamp, role string, model string, input_tokens long, output_tokens long, total_tokens long, "
    "latency_ms decimal(14,2), confidence_score decimal(6,4), human_approved boolean, rag_chunks_used int, success boolean"
)


def calls(spark):
    from decimal import Decimal as D

    at = datetime(2024, 1, 30, 12)
    return metrics.call_cost(
        spark.createDataFrame(
            [
                ("1", at, "chat", "gpt-4", 1000, 500, 1500, D(1000), D("0.8"), True, 2, True),
                ("2", at, "chat", "mock", 10, 5, 15, D(3000), None, None, 0, True),
                ("3", datetime(2024, 1, 2), "doc", "new-model", 9, 1, 10, D(10), D("1.0"), False, 0, False),
            ],
            CALLS,
        )
    )


def test_call_metrics(spark):
    df = calls(spark)
    costs = {r["call_id"]: float(r["cost_usd"]) for r in df.collect()}
    assert costs == {"1": 0.06, "2": 0.0, "3": 0.0}
    s = metrics.call_summary(metrics.last_days(df, "2024-01-31 00:00:00", 7), 7).first()
    assert (s["total_calls"], s["total_tokens"], s["total_cost_usd"], s["avg_latency_ms"]) == (2, 1515, 0.06, 2000.0)
    assert (s["success_rate"], s["avg_confidence"], s["human_approval_rate"], s["period_days"]) == (100.0, 0.8, 100.0, 7)
    bins = {(r["role"], r["bin"]): r["calls"] for r in metrics.confidence_histogram(df).collect()}
    assert bins == {("chat", 16): 1, ("doc", 19): 1}
    approved = {r["role"]: (r["approved"], r["decided"], r["approval_rate"]) for r in metrics.approval_by_role(df).collect()}
    assert approved == {"chat": (1, 1, 100.0), "doc": (0, 1, 0.0), None: (1, 2, 50.0)}


def test_empty_summary(spark):
    s = metrics.call_summary(calls(spark).filter("false"), 7).first()
    assert tuple(s) == (0, 0, 0.0, 0.0, 0.0, None, None, 0)


@pytest.mark.parametrize("state,errors,minutes,want", [("Failed", 0, 1, "ERROR"), ("Success", 0, 31, "WARNING"), ("Success", 1, 1, "WARNING"), ("Warning", 0, 1, "WARNING"), ("Success", 0, 30, "HEALTHY")])
def test_run_status(spark, state, errors, minutes, want):
    df = spark.createDataFrame([(state, errors, minutes)], "s string, e int, m int")
    assert df.select(metrics.run_status("s", "e", "m")).first()[0] == want


def test_alerts(spark):
    runs = spark.createDataFrame([("a", 45.0), ("a", 10.0), ("b", 1.0)], "run_name string, duration_min double")
    rules = spark.createDataFrame([("t", "r1", 3, "FAIL"), ("t", "r2", 1, "WARN"), ("t", "r3", 0, "PASS")], "table_name string, rule string, violations long, status string")
    fresh = spark.createDataFrame([("t", "ERROR"), ("u", "PASS")], "table_name string, status string")
    state = drift.assess(drifted(spark, BASE[:2]), spark.createDataFrame([("t",)], "table_name string"))
    out = metrics.build_alerts(state, runs, rules, fresh)
    assert sorted((r["severity"], r["subject"]) for r in out.collect()) == [
        ("CRITICAL", "t.r1"), ("ERROR", "t"), ("ERROR", "t"), ("INFO", "a"), ("WARNING", "t.r2")]
    c = metrics.alert_counts(out).first()
    assert (c["alerts"], c["critical_count"], c["error_count"], c["warning_count"], c["info_count"]) == (5, 1, 2, 1, 1)


def test_error_history_and_contract_chunks(spark):
    solved = spark.createDataFrame([("e", "cause", "fix", "schema_drift")], "error string, root_cause string, resolution string, category string")
    every = retrieval.union_sources(retrieval.error_pattern_chunks(spark, solved), contracts.contract_chunks(spark))
    assert every.count() == 6 and every.filter(F.col("chunk_type") == "contract").count() == 5


def test_vector_queries_grow_with_the_table(spark):
    import __spark_entry__ as entry_points

    folder = "/root/testdata/sf0.001"
    asked = {r.vec_id for r in spark.read.parquet(f"{folder}/embeddings.parquet").collect() if r.vec_id % 100 == 0}
    got = entry_points.queries()["rag_rank_vectors"](spark, folder).collect()
    assert {r.query_id for r in got} == asked and len(got) == 5 * len(asked)


def test_chain_of_4096_tables_in_few_rounds(spark, monkeypatch):
    rounds, real = [], lineage.materialize
    monkeypatch.setattr(lineage, "materialize", lambda df, name: rounds.append(name) or real(df, name))
    edges = spark.range(4095).selectExpr("concat('t', id) as src", "concat('t', id + 1) as dst")
    out = lineage.closure(edges, spark.createDataFrame([("t0",)], "root string"))
    assert out.count() == 4095 and out.filter("node <> concat('t', depth)").count() == 0
    assert rounds.count("lineage") - 1 <= 14


def test_lineage_takes_the_shortest_of_many_ways(spark):
    rng = random.Random(6)
    pairs = {(rng.randrange(40), rng.randrange(40)) for _ in range(70)}
    out = lineage.closure(spark.createDataFrame([(f"n{a}", f"n{b}") for a, b in pairs], "src string, dst string"), spark.createDataFrame([("n1",), ("n2",), ("n99",)], "root string"))
    want = set()
    for root in (1, 2, 99):
        depth, level = {root: 0}, [root]
        while level:
            level = [b for b in {b for a, b in pairs if a in level} if b not in depth and not depth.update({b: max(depth[x] for x in level) + 1})]
        want |= {(f"n{root}", f"n{n}", d) for n, d in depth.items() if d}
    assert {tuple(r) for r in out.collect()} == want


def test_templates_of_errors(spark):
    texts = [f"Connection to host{n} refused after {n} ms by peer p{n % 3}" for n in range(40)] + [f"Disk full on {w}" for w in "a b c d e f g h i j".split()]
    texts += ["Table missing now", "Table empty now", None, "", "  "]
    df = spark.createDataFrame(list(enumerate(texts)), "log_id long, text string").repartition(3)
    got = {r.template: (r.occurrences, r.first_id, r.last_id) for r in triage.error_templates(df).collect()}
    assert got == {
        "Connection to <*> refused after <*> ms by peer <*>": (40, 0, 39), "Disk full on <*>": (10, 40, 49),
        "Table missing now": (1, 50, 50), "Table empty now": (1, 51, 51), "": (3, 52, 54),
    }


def test_renamed_columns_are_matched_one_to_one(spark):
    old = spark.range(5000).selectExpr("id as key", "cast(id % 7 as int) as small", "concat('n', id) as name", "concat('n', id + 100) as other", "cast(null as string) as empty")
    new = old.selectExpr("key", "small as tiny", "name as title", "other as label", "cast(null as string) as blank")
    rows = [[(c, t) for c, t in df.dtypes] for df in (old, new)]
    sides = [spark.createDataFrame([("t", c, t, True) for c, t in x], "table_name string, column_name string, data_type string, nullable boolean") for x in rows]
    changes = drift.compare(*sides)
    values = [drift.value_sketches(df).withColumn("table_name", F.lit("t")) for df in (old, new)]
    found = {(r.old_name, r.new_name) for r in drift.renamed(changes, *values).collect()}
    assert found == {("small", "tiny"), ("name", "title"), ("other", "label")}
    out = drift.with_renames(changes, drift.renamed(changes, *values))
    assert sorted((r.change_type, r.column_name) for r in out.collect()) == [("COLUMN_ADDED", "blank"), ("COLUMN_REMOVED", "empty"), ("RENAMED", "label"), ("RENAMED", "tiny"), ("RENAMED", "title")]
    assert drift.assess(out, sides[0]).first().severity == "ERROR"
