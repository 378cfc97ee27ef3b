"""Personal data by anchor expansion.

One Aho-Corasick pass finds anchors: at-signs, plus signs, digits, schemes and identifier cues. From each anchor a small
deterministic parser widens to the boundaries of an address, number or account and validates it. Kinds, in the order used
for ties: ``email ip card phone`` (fixed rules), then what the method adds: ``iban`` (check digits hold), ``access_key``,
``secret`` (value after a cue such as ``password=``), ``userinfo`` (``user:password@`` of a URL).

Defined cases: a null text is empty and has no spans; spans are code points, end exclusive; spans of one kind never
overlap, spans of different kinds may; rows are judged one by one, so ties, repeated rows and extra columns pass through.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

BASE_KINDS = ("email", "ip", "card", "phone")
KINDS = (*BASE_KINDS, "iban", "access_key", "secret", "userinfo")
SPAN = "array<struct<kind:string,start:int,end:int>>"
#: Cues of the added kinds (fixed values).
SECRET_CUES = ("password", "passwd", "secret", "token", "api_key", "apikey", "api-key", "access_key", "auth_key")
KEY_CUES = ("AKIA", "ASIA", "ghp_", "gho_", "xoxb-", "xoxp-")
#: Length of an IBAN by country (fixed values).
IBAN_LENGTHS = {
    "AT": 20, "BE": 16, "CH": 21, "CZ": 24, "DE": 22, "DK": 18, "ES": 24, "FI": 18, "FR": 27, "GB": 22, "GR": 27, "HU": 28,
    "IE": 22, "IT": 27, "LU": 20, "NL": 18, "NO": 15, "PL": 28, "PT": 25, "RO": 24, "SE": 24, "SK": 24,
}

LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
WORD = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789_")
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
DIGITS = re.compile(r"[0-9]+")
QUAD = re.compile(r"[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+")
CHAIN = re.compile(r"[0-9](?:[ -]?[0-9])+")
PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
IBAN = re.compile(r"[0-9]{2}(?: ?[A-Z0-9]){11,30}")
KEY = re.compile(r"[A-Za-z0-9_-]*")
KEY_MARK = re.compile(r"[A-Z0-9]")
ASSIGNED = re.compile(r"[\"']?[ \t]{0,3}[=:][ \t]{0,3}[\"']?")
VALUE = re.compile(r"[^\s\"'<>]*")
DIGIT = re.compile(r"[0-9]")
USER = re.compile(r"[^\s/@:]+:[^\s/@]+(?=@)")


def luhn(digits: str) -> bool:
    odd = sum(map(int, digits[-1::-2]))
    return (odd + sum(d * 2 - 9 * (d > 4) for d in map(int, digits[-2::-2]))) % 10 == 0


def iban_length(text: str, at: int) -> int:
    """Characters of a valid IBAN that starts at ``at``, 0 if there is none."""
    want, taken, end = IBAN_LENGTHS[text[at : at + 2]], "", at
    while end < len(text) and len(taken) < want:
        c = text[end]
        if c == " " and taken:
            end += 1
            continue
        if not ("0" <= c <= "9" or "A" <= c <= "Z"):
            return 0
        taken += c
        end += 1
    if len(taken) < want or (end < len(text) and text[end] in WORD):
        return 0
    return end - at if int("".join(str(int(c, 36)) for c in taken[4:] + taken[:4])) % 97 == 1 else 0


class Runs:
    """Runs of one kind of characters, each walked once however many anchors stand in it."""

    def __init__(self, text: str, run: re.Pattern, mark: re.Pattern):
        self.text, self.run, self.mark = text, run, mark
        self.end = self.next_mark = -1

    def at(self, place: int) -> tuple[int, int]:
        """Where the run around ``place`` ends, and the first mark from ``place`` on (the end if there is none). Places must not decrease."""
        if place >= self.end:
            self.end, self.next_mark = self.run.match(self.text, place).end(), -1
        if self.next_mark < place:
            m = self.mark.search(self.text, place, self.end)
            self.next_mark = m.start() if m else self.end
        return self.end, self.next_mark


def anchors() -> ahocorasick.Automaton:
    found = ahocorasick.Automaton()
    for s in "0123456789@+":
        found.add_word(s, (s if s in "@+" else "0", 1))
    for kind, cues in (("secret", (f(c) for c in SECRET_CUES for f in (str.lower, str.upper, str.capitalize))), ("key", KEY_CUES)):
        for s in cues:
            found.add_word(s, (kind, len(s)))
    for s in IBAN_LENGTHS:
        for d in "0123456789":
            found.add_word(s + d, ("iban", 3))
    found.add_word("://", ("scheme", 3))
    found.make_automaton()
    return found


def find_spans(text: str, automaton: ahocorasick.Automaton) -> list[tuple[int, int, int]]:
    """(start, number of the kind, end) of every span, sorted."""
    out: list[tuple[int, int, int]] = []
    end = [0] * len(KINDS)  # where the last match of each kind ended, counted whether or not it was valid
    run_end = 0
    keys, values = Runs(text, KEY, KEY_MARK), Runs(text, VALUE, DIGIT)

    def take(kind: int, start: int, stop: int, valid: bool) -> None:
        end[kind] = stop
        if valid:
            out.append((start, kind, stop))

    for last, (what, length) in automaton.iter(text):
        at = last - length + 1
        if what == "0":
            if at >= run_end:
                run_end = DIGITS.match(text, at).end()
                if at >= end[1] and (m := QUAD.match(text, at)):
                    take(1, at, m.end(), all(len(p.lstrip("0")) < 4 and int(p.lstrip("0") or "0") < 256 for p in m.group().split(".")))
                if at >= end[2] and (m := CHAIN.match(text, at)):
                    digits = m.group().replace(" ", "").replace("-", "")
                    take(2, at, m.end(), 14 <= len(digits) <= 19 and luhn(digits))
        elif what == "@":
            start = at
            while start > end[0] and text[start - 1] in LOCAL:
                start -= 1
            if start < at and (m := DOMAIN.match(text, last + 1)):
                take(0, start, m.end(), True)
        elif what == "+":
            if at >= end[3] and (m := PHONE.match(text, at)):
                take(3, at, m.end(), 10 <= sum("0" <= c <= "9" for c in m.group()) <= 15)
        elif what == "iban":
            if at >= end[4] and not (at and text[at - 1] in WORD) and (n := iban_length(text, at)):
                take(4, at, at + n, True)
        elif what == "key":
            if at >= end[5] and not (at and text[at - 1] in WORD):
                stop, mark = keys.at(at + length)
                if stop - at >= 16 and mark < stop:
                    take(5, at, stop, True)
        elif what == "secret":
            m = ASSIGNED.match(text, last + 1)
            if m and m.end() >= end[6]:
                stop, digit = values.at(m.end())
                if stop - m.end() >= 8 and digit < stop:
                    take(6, m.end(), stop, True)
        elif at and (m := USER.match(text, last + 1)) and m.start() >= end[7]:
            take(7, m.start(), m.end(), True)
    return sorted(out)


def add_spans(docs: DataFrame, text: str = "text", to: str = "pii") -> DataFrame:
    """All columns of ``docs`` and, in place of any column ``to``, the spans of each row's whole text, by start and kind."""
    docs = docs.drop(to)
    schema = T.StructType([*docs.schema.fields, T.StructField(to, T._parse_datatype_string(SPAN))])
    kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = anchors()
        for batch in batches:
            spans = []
            for value in batch.column(batch.schema.get_field_index(text)):
                found = find_spans(value.as_py() or "", automaton)
                spans.append([{"kind": KINDS[k], "start": a, "end": b} for a, k, b in found])
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(spans, kind)], names=[*batch.schema.names, to])

    return docs.mapInArrow(search, schema)


def mask(text: str, spans: list[tuple[str, int, int]]) -> str:
    """The text with each span, or run of overlapping spans, replaced by the name of its first kind."""
    out, at = [], 0
    for kind, start, end in spans:
        if start >= at:
            out += [text[at:start], f"<{kind.upper()}>"]
        at = max(at, end)
    return "".join([*out, text[at:]])


def mask_documents(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with personal data replaced; ``n_chars``, where present, follows the text. Null texts stay null."""

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = anchors()
        for batch in batches:
            at = batch.schema.get_field_index(text)
            new = []
            for value in batch.column(at):
                t = value.as_py()
                found = find_spans(t, automaton) if t else []
                new.append(mask(t, [(KINDS[k], a, b) for a, k, b in found]) if found else t)
            yield batch.set_column(at, batch.schema.field(at), pa.array(new, batch.schema.field(at).type))

    out = docs.mapInArrow(search, docs.schema)
    return out.withColumn("n_chars", F.char_length(text).cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else out
