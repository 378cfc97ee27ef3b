"""Masking, hashing and counting of personal data, as built-in expressions.

Matches are replaced by splitting the text at a pattern, masking the matches and joining both again,
so whole texts are rebuilt exactly. Patterns are Unicode-aware and ignore case.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from granary.sources.contracts import Contract

# Patterns in the order they are applied, and key names whose values are always hidden.
EMAIL = r"\b[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Z|a-z]{2,}\b"
PHONE_BR = r"\b(?:\+55\s?)?\(?\d{2}\)?\s?\d{4,5}[-.\s]?\d{4}\b"
CPF = r"\b\d{3}\.?\d{3}\.?\d{3}[-.]?\d{2}\b"
CREDIT_CARD = r"\b(?:\d{4}[-.\s]?){3}\d{4}\b"
IP_ADDRESS = r"\b(?:\d{1,3}\.){3}\d{1,3}\b"
PATTERNS = {
    "email": EMAIL,
    "phone_br": PHONE_BR,
    "cpf": CPF,
    "credit_card": CREDIT_CARD,
    "ip_address": IP_ADDRESS,
}
SENSITIVE_KEYS = ("password", "secret", "token", "key", "credential")
HIDDEN = "********"
STRICT_PHONE = r"(?:\+55\s?|\b)\(?\d{2}\)?\s?\d{4,5}[-.\s]?\d{4}\b"
STRICT_ORDER = ("email", "credit_card", "ip_address", "cpf", "phone_br")

_FLAGS = "(?iU)"


def _col(value: str | Column) -> Column:
    return F.col(value) if isinstance(value, str) else value


def _bind(value: Column, body: Callable[[Column], Column]) -> Column:
    """Evaluate ``value`` once and use it several times in ``body``."""
    return F.element_at(F.transform(F.array(value), body), 1)


def mask_email(match: Column, keep_dots: bool = False) -> Column:
    local = F.substring_index(match, "@", 1)
    domain = F.substring_index(match, "@", -1)
    head = F.substring_index(domain, ".", 1)
    tail = F.substr(domain, F.length(head) + 2)

    def first(part: Column) -> Column:
        return F.when(F.length(part) > 1, F.concat(F.substring(part, 1, 1), F.lit("***"))).otherwise("***")

    rest = tail if keep_dots else F.replace(tail, F.lit("."), F.lit(""))
    return F.concat(first(local), F.lit("@"), first(head), F.lit("."), rest)


def mask_generic(match: Column, start: int = 3, end: int = 2) -> Column:
    """Keep the first and last alphanumerics, star the rest; short values are starred whole."""
    clean = F.regexp_replace(match, "[^A-Za-z0-9]", "")
    stars = F.repeat(F.lit("*"), F.length(clean) - F.lit(start + end))
    tail = F.right(clean, F.lit(end)) if end else F.lit("")
    masked = F.concat(F.substring(clean, 1, start), stars, tail)
    return F.when(F.length(clean) <= start + end, F.repeat(F.lit("*"), F.length(match))).otherwise(masked)


def mask_card(match: Column) -> Column:
    clean = F.regexp_replace(match, "[^0-9]", "")
    shown = F.concat(F.lit("**** **** **** "), F.right(clean, F.lit(4)))
    return F.when(F.length(clean) >= 4, shown).otherwise("****")


MASKS: dict[str, Callable[[Column], Column]] = {
    "email": mask_email,
    "phone_br": mask_generic,
    "cpf": mask_generic,
    "credit_card": mask_card,
    "ip_address": lambda m: mask_generic(m, 3, 0),
}


def _replace_matches(text: Column, pattern: str, mask: Callable[[Column], Column]) -> Column:
    def rebuilt(t: Column) -> Column:
        found = F.transform(F.regexp_extract_all(t, F.lit(pattern), F.lit(0)), lambda m: mask(m))
        parts = F.zip_with(F.split(t, pattern, -1), found, lambda p, m: F.concat(p, F.coalesce(m, F.lit(""))))
        return F.when(t.rlike(pattern), F.array_join(parts, "")).otherwise(t)

    return _bind(text, rebuilt)


def mask_text(value: str | Column, strict: bool = False) -> Column:
    """Mask every pattern in turn.

    The default order masks phones and tax numbers before cards and addresses. ``strict`` masks the
    longer patterns first, keeps the dots of mail domains and covers the country prefix of phones.
    """
    out = _col(value)
    for name in STRICT_ORDER if strict else PATTERNS:
        pattern = STRICT_PHONE if strict and name == "phone_br" else PATTERNS[name]
        mask = (lambda m: mask_email(m, keep_dots=True)) if strict and name == "email" else MASKS[name]
        out = _replace_matches(out, _FLAGS + pattern, mask)
    return out


def is_sensitive(key: Column, words: tuple[str, ...] = SENSITIVE_KEYS) -> Column:
    hit = F.lit(False)
    for w in words:
        hit = hit | F.lower(key).contains(w)
    return hit


def mask_nested(value: Column, data_type: T.DataType, words: tuple[str, ...] = SENSITIVE_KEYS) -> Column:
    """Mask texts inside maps and structs to any depth; values under sensitive names are hidden."""
    if isinstance(data_type, T.StringType):
        return mask_text(value)
    if isinstance(data_type, T.MapType):
        inner = data_type.valueType

        def one(k: Column, v: Column) -> Column:
            masked = mask_nested(v, inner, words)
            if isinstance(inner, T.StringType):
                return F.when(is_sensitive(k, words), F.lit(HIDDEN)).otherwise(masked)
            # a value that cannot hold the marker is removed instead
            return F.when(~is_sensitive(k, words), masked)

        return F.transform_values(value, one)
    if isinstance(data_type, T.StructType):
        fields = []
        for f in data_type:
            hide = any(w in f.name.lower() for w in words)
            inner = F.lit(HIDDEN) if hide else mask_nested(value[f.name], f.dataType, words)
            fields.append(inner.alias(f.name))
        return F.when(value.isNotNull(), F.struct(*fields))
    return value


def hash_pii(value: str | Column, salt: str) -> Column:
    """First 16 hex digits of SHA-256 over salt and value: a stable pseudonym."""
    return F.substring(F.sha2(F.concat(F.lit(salt), _col(value).cast("string")), 256), 1, 16)


def mask_by(strategy: str, value: Column, salt: str) -> Column:
    text = value.cast("string")
    if strategy == "hash":
        return hash_pii(value, salt)
    if strategy == "partial":
        return mask_generic(text)
    if strategy == "full":
        return F.when(value.isNotNull(), F.lit(HIDDEN))
    raise ValueError(f"unknown masking strategy {strategy!r}")


def mask_columns(df: DataFrame, contract: Contract, salt: str) -> DataFrame:
    """Mask the personal columns a contract names; those without a strategy are hidden in full."""
    masks = {
        f.name: mask_by(f.mask or "full", F.col(f.name), salt)
        for f in contract.fields
        if f.pii and f.name in df.columns
    }
    return df.withColumns(masks) if masks else df


def scan(df: DataFrame, columns: list[str], table: str) -> DataFrame:
    """Hits and affected rows per column and pattern, from one pass over the table."""
    sums, rows = [], []
    for i, c in enumerate(columns):
        for name, pattern in PATTERNS.items():
            hits = F.regexp_count(F.col(c), F.lit(_FLAGS + pattern))
            sums += [F.coalesce(F.sum(hits), F.lit(0)).alias(f"_h{i}_{name}"), F.count_if(hits > 0).alias(f"_r{i}_{name}")]
            rows.append(
                F.struct(
                    F.lit(c).alias("column_name"),
                    F.lit(name).alias("pattern"),
                    F.col(f"_h{i}_{name}").cast("long").alias("hits"),
                    F.col(f"_r{i}_{name}").alias("rows_hit"),
                )
            )
    return df.agg(*sums).select(F.lit(table).alias("table_name"), F.inline(F.array(*rows)))
