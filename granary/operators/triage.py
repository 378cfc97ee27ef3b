"""Error triage: class, impact and advice per log text, and groups of like errors."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from granary.functions.text import error_signature, first_match
from granary.operators.retrieval import build_context, rank_keyword
from granary.operators.skew import join_unique

# Key words per class (first match wins) and the analysis attached to each class.
RULES = [
    ("SchemaDrift", ["schema", "column", "drift"]),
    ("ConnectionFailure", ["connection", "refused", "timeout"]),
    ("DataQuality", ["null", "quality", "validation"]),
]
OTHER = "Unknown"
ANALYSES = {
    "SchemaDrift": {
        "business_impact": "MEDIUM",
        "affected_tables": ["bronze.customers", "silver.stg_customers"],
        "recommended_action": "The delivered columns no longer fit. Compare them with the contract, agree on the change with "
        "its owner, then load the affected days again.",
        "confidence_score": 0.85,
    },
    "ConnectionFailure": {
        "business_impact": "HIGH",
        "affected_tables": ["bronze.customers", "bronze.products", "bronze.stores"],
        "recommended_action": "The source did not answer. Find out whether it, or the way to it, is down. Loads can be "
        "repeated safely once it is back.",
        "confidence_score": 0.90,
    },
    "DataQuality": {
        "business_impact": "HIGH",
        "affected_tables": ["bronze.orders"],
        "recommended_action": "Rows broke a rule and wait in quarantine. Trace them to their load before any of them "
        "is released.",
        "confidence_score": 0.88,
    },
    "Unknown": {
        "business_impact": "MEDIUM",
        "affected_tables": [],
        "recommended_action": "No rule knows this message. Read the whole log, name the class and add a rule for it.",
        "confidence_score": 0.30,
    },
}


def error_type(text: str | Column) -> Column:
    return first_match(text, RULES, OTHER)


def analysis(kind: Column) -> Column:
    """Struct with impact, tables, action and confidence of a class. The table is fixed, so no join."""
    out = None
    for name, a in ANALYSES.items():
        tables = F.array(*[F.lit(t) for t in a["affected_tables"]]).cast("array<string>")
        body = F.struct(
            F.lit(a["business_impact"]).alias("business_impact"),
            tables.alias("affected_tables"),
            F.lit(a["recommended_action"]).alias("recommended_action"),
            F.lit(a["confidence_score"]).alias("confidence_score"),
            F.lit(True).alias("requires_human_approval"),
        )
        out = F.when(kind == name, body) if out is None else out.when(kind == name, body)
    return out


def triage(df: DataFrame, text: str = "text") -> DataFrame:
    typed = df.withColumn("error_type", error_type(text))
    return typed.withColumn("_a", analysis(F.col("error_type"))).select("*", "_a.*").drop("_a")


def error_groups(df: DataFrame, text: str = "text", id_column: str = "log_id") -> DataFrame:
    """Like errors (numbers and quoted parts ignored) with their count, an example and the analysis."""
    keyed = df.select(
        error_signature(text).alias("signature"), error_type(text).alias("error_type"), F.col(id_column).alias("_id")
    )
    groups = keyed.groupBy("signature", "error_type").agg(
        F.count(F.lit(1)).alias("occurrences"), F.min("_id").alias("first_id"), F.max("_id").alias("last_id")
    )
    return groups.withColumn("_a", analysis(F.col("error_type"))).select("*", "_a.*").drop("_a")


def error_templates(df: DataFrame, text: str = "text", id_column: str = "log_id", depth: int = 2, variants: int = 8) -> DataFrame:
    """Groups of errors with one wording, found from the logs: a template has ``<*>`` where its errors differ.

    A parse tree of fixed depth leads each text to a leaf by its number of tokens and its first ``depth`` tokens (those
    with digits count as ``<*>``). In a leaf, a position with more than ``variants`` different tokens, or with digits in any
    of them, varies. The rule looks at a whole leaf at once, so the order of the logs does not matter. Null texts have no
    tokens. Tokens are counted before they are shuffled: a leaf that holds a third of all logs sends a row per task,
    position and different token.
    """
    tokens = F.filter(F.split(F.coalesce(text, F.lit("")), r"\s+"), lambda w: w != "")
    masked = F.transform(F.slice(tokens, 1, depth), lambda w: F.when(w.rlike("[0-9]"), "<*>").otherwise(w))
    leaf = ["_length", "_lead"]
    rows = df.select(F.col(id_column).alias("_id"), tokens.alias("_tokens"), F.size(tokens).alias("_length"), F.array_join(masked, " ").alias("_lead"))
    words = rows.select(*leaf, F.posexplode("_tokens").alias("_at", "_word")).groupBy(*leaf, "_at", "_word").agg(F.lit(1))
    spots = words.groupBy(*leaf, "_at").agg(F.count(F.lit(1)).alias("_n"), F.max(F.col("_word").rlike("[0-9]")).alias("_digits"))
    varying = spots.filter((F.col("_n") > variants) | F.col("_digits")).groupBy(*leaf).agg(F.collect_set("_at").alias("_varying"))
    # a leaf's list is no longer than its texts
    kept = join_unique(rows, varying, leaf, "left")
    shown = F.transform("_tokens", lambda w, k: F.when(F.array_contains(F.coalesce("_varying", F.array().cast("array<int>")), k), "<*>").otherwise(w))
    named = kept.select("_id", F.array_join(shown, " ").alias("template"))
    return named.groupBy("template").agg(F.count(F.lit(1)).alias("occurrences"), F.min("_id").alias("first_id"), F.max("_id").alias("last_id"))


def triage_batch(df: DataFrame, text: str = "text", id_column: str = "log_id") -> DataFrame:
    """Every log with the analysis of its group and the group's size; very large groups stay spread."""
    groups = error_groups(df, text, id_column).drop("first_id", "last_id")
    keyed = df.withColumns({"signature": error_signature(text), "error_type": error_type(text)})
    return join_unique(keyed, groups, ["signature", "error_type"])


def triage_with_context(errors: DataFrame, chunks: DataFrame, text: str = "text", id_column: str = "log_id") -> DataFrame:
    """Every error with its analysis and the context retrieved for its text: prompt text, number of chunks, token estimate.

    ``chunks`` as in ``retrieval.rank_keyword`` and ``build_context``. An error for which nothing is found has 0 chunks.
    """
    asked = errors.select(F.col(id_column).alias("query_id"), F.col(text).alias("query"))
    found = build_context(rank_keyword(asked, chunks), chunks).drop("query_type")
    found = found.withColumnRenamed("query_id", id_column)
    out = join_unique(triage(errors, text), found, [id_column], "left")
    return out.withColumns({c: F.coalesce(c, F.lit(0).cast("long")) for c in ("chunks", "estimated_tokens")})
