"""Chat formatting by a grammar round trip, in built-in expressions only.

A turn is ``open role \\n text close``: assistant turns stand between ``<s>`` and ``</s>``, all others between ``[INST]``
and ``[/INST]``. The parser cuts a rendered text at the control strings and accepts only a list of (open, body, matching
close). A conversation is rendered as it is and parsed; where the recovered turns differ from the source, its texts are
escaped (one ``\\`` more after the first character of each control string, escaped or not) and it is rendered again.
The parser always takes one ``\\`` away, so a text that only looks escaped is escaped as well.

Defined cases: a null text or role is empty; turns sort by (turn, role, text), nulls first, so ties and repeated rows
have one order and stay separate turns; a null ``conv_id`` is a conversation of its own; an empty table gives no rows;
other columns of the input are ignored.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ASSISTANT = "assistant"
MARKS = ("<s>", "</s>", "[INST]", "[/INST]")
#: Control strings of a tokenizer's vocabulary that a text must not carry in raw form; the marks always belong to them.
CONTROLS = (*MARKS, "<|endoftext|>", "<<SYS>>", "<</SYS>>")


def _patterns(controls: tuple[str, ...]) -> tuple[str, str, str]:
    """To escape, to unescape, and to cut at control strings."""
    first = "".join(sorted({re.escape(c[0]) for c in controls}))
    rest = "|".join(re.escape(c[1:]) for c in sorted(controls))
    whole = "|".join(re.escape(c) for c in sorted(controls))
    last = "".join(sorted({re.escape(c[-1]) for c in controls}))
    cut = f"(?=[{first}])(?={whole})|(?<=[{last}])(?<={whole})"  # one look at a character rules most places out
    return f"([{first}])(\\\\*)(?={rest})", f"([{first}])(\\\\*)\\\\(?={rest})", cut


def _render(turns: Column, escape: str | None) -> Column:
    """The template. The role stands on a line of its own, so its line breaks are percent-coded."""

    def one(t: Column) -> Column:
        role = F.replace(F.replace(t["role"], F.lit("%"), F.lit("%25")), F.lit("\n"), F.lit("%0A"))
        body = F.concat(role, F.lit("\n"), t["text"])
        body = F.regexp_replace(body, escape, "$1$2\\\\") if escape else body
        user = F.concat(F.lit("[INST]"), body, F.lit("[/INST]"))
        return F.when(t["role"] == ASSISTANT, F.concat(F.lit("<s>"), body, F.lit("</s>"))).otherwise(user)

    return F.array_join(F.transform(turns, one), "")


def _well_formed(parts: Column) -> Column:
    """Whether marks and bodies follow the grammar."""

    def right(x: Column, i: Column) -> Column:
        before, after = F.get(parts, i - 1), F.get(parts, i + 1)
        pair = ((before == "<s>") & (after == "</s>")) | ((before == "[INST]") & (after == "[/INST]"))
        return (i % 3 != 1) | F.coalesce(pair & ~x.isin(*MARKS), F.lit(False))

    return (F.size(parts) % 3 == 0) & F.forall(F.transform(parts, lambda x, i: right(x, i)), lambda ok: ok)


def _parse(parts: Column, unescape: str) -> Column:
    """(role, text) of each body."""

    def one(body: Column) -> Column:
        plain = F.regexp_replace(body, unescape, "$1$2")
        role = F.substring_index(plain, "\n", 1)
        text = F.substring(plain, F.char_length(role) + F.lit(2), F.char_length(plain))
        role = F.replace(F.replace(role, F.lit("%0A"), F.lit("\n")), F.lit("%25"), F.lit("%"))
        return F.struct(role.alias("role"), text.alias("text"))

    return F.transform(F.filter(parts, lambda x, i: i % 3 == 1), one)


def _cut(formatted: str, cut: str) -> Column:
    return F.filter(F.split(F.col(formatted), cut, -1), lambda x: x != "")


def format_chats(rows: DataFrame, controls: tuple[str, ...] = CONTROLS) -> DataFrame:
    """One row per ``conv_id``: ``formatted``, the ``turns`` read back from it, whether they equal the source
    (``round_trip``), and ``loss_spans``, the code-point ranges of assistant texts in ``formatted``.
    """
    escape, unescape, cut = _patterns(tuple(dict.fromkeys((*MARKS, *controls))))
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    turn = F.struct(F.col("turn"), text("role").alias("role"), text("text").alias("text"))
    source = F.transform(F.sort_array(F.collect_list(turn)), lambda t: F.struct(t["role"].alias("role"), t["text"].alias("text")))
    chats = rows.select("conv_id", "turn", "role", "text").groupBy("conv_id").agg(source.alias("source"))
    raw = chats.withColumn("raw", _render(F.col("source"), None)).withColumn("parts", _cut("raw", cut))
    same = _well_formed(F.col("parts")) & (_parse(F.col("parts"), unescape) == F.col("source"))
    formatted = F.when(same, F.col("raw")).otherwise(_render(F.col("source"), escape))
    done = raw.select("conv_id", "source", formatted.alias("formatted")).withColumn("parts", _cut("formatted", cut))
    back = done.withColumn("turns", F.when(_well_formed(F.col("parts")), _parse(F.col("parts"), unescape)))
    # where each part starts: the parts' lengths summed in order
    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,end:int>>").alias("spans"))

    def step(acc: Column, p: Column) -> Column:
        end = acc["at"] + F.char_length(p["x"])
        first = acc["at"] + F.lit(len(ASSISTANT) + 1)
        mine = (p["i"] % 3 == 1) & (F.get(F.col("parts"), p["i"] - 1) == "<s>")
        spans = F.when(mine, F.concat(acc["spans"], F.array(F.struct(first.alias("start"), end.alias("end"))))).otherwise(acc["spans"])
        return F.struct(end.alias("at"), spans.alias("spans"))

    placed = F.transform(F.col("parts"), lambda x, i: F.struct(x.alias("x"), i.alias("i")))
    return back.select(
        "conv_id",
        "formatted",
        "turns",
        F.coalesce(F.col("turns") == F.col("source"), F.lit(False)).alias("round_trip"),
        F.aggregate(placed, start, step, lambda acc: acc["spans"]).alias("loss_spans"),
    )


def loss_text(controls: tuple[str, ...] = CONTROLS) -> Column:
    """The text under the loss mask of ``format_chats``, unescaped."""
    unescape = _patterns(tuple(dict.fromkeys((*MARKS, *controls))))[1]
    cut = lambda s: F.substring(F.col("formatted"), s["start"] + 1, s["end"] - s["start"])
    return F.array_join(F.transform("loss_spans", lambda s: F.regexp_replace(cut(s), unescape, "$1$2")), "")
