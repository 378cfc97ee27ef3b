"""Text cleaning, key-word ladders and token sets."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(value: str | Column) -> Column:
    return F.col(value) if isinstance(value, str) else value


def proper(value: str | Column) -> Column:
    return F.initcap(F.trim(_col(value)))


def upper_code(value: str | Column) -> Column:
    return F.upper(F.trim(_col(value)))


def phone_digits(value: str | Column) -> Column:
    return F.regexp_replace(_col(value), "[^0-9+]", "")


def same_text(value: str | Column, wanted: str) -> Column:
    """Case-insensitive equality with a literal."""
    return F.lower(_col(value)) == F.lit(wanted.lower())


def first_match(value: str | Column, rules: list[tuple[str, list[str]]], otherwise: str) -> Column:
    """Label of the first rule with a key word inside the lower-cased text (substring match)."""
    text = F.lower(_col(value))
    out = None
    for label, words in rules:
        hit = F.lit(False)
        for word in words:
            hit = hit | text.contains(word)
        out = F.when(hit, label) if out is None else out.when(hit, label)
    return out.otherwise(otherwise)


def word_set(value: str | Column) -> Column:
    """Distinct lower-cased white-space tokens."""
    tokens = F.split(F.lower(_col(value)), r"(?U)\s+")
    return F.array_remove(F.array_distinct(tokens), "")


def error_signature(value: str | Column) -> Column:
    """Message with quoted parts and numbers masked, so that like errors group together."""
    quoted = F.regexp_replace(_col(value), "'[^']*'|\"[^\"]*\"", "<q>")
    numbered = F.regexp_replace(quoted, "[0-9]+", "<n>")
    return F.lower(F.trim(F.regexp_replace(numbered, r"\s+", " ")))


def cosine(a: str | Column, b: str | Column) -> Column:
    """Cosine similarity of two double arrays; 0 where a norm is zero."""
    x, y = _col(a), _col(b)

    def dot(p: Column, q: Column) -> Column:
        return F.aggregate(F.zip_with(p, q, lambda i, j: i * j), F.lit(0.0), lambda acc, v: acc + v)

    norms = F.sqrt(dot(x, x)) * F.sqrt(dot(y, y))
    return F.when(norms == 0.0, 0.0).otherwise(dot(x, y) / F.nullif(norms, F.lit(0.0)))
