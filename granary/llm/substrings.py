"""Repeated substrings across all documents, by a sparse suffix array (deep-shallow sorting).

Looked for is every string of ``SIZE`` bytes that starts at two places or more. Each such string contains grams of ``GRAM``
bytes; the one whose hash is least (the first of equals) is its anchor, at the same place within every occurrence. So only
anchors, about one byte in seventy, are shuffled, and only those whose gram occurs again are looked at: their surroundings
meet by gram, and the suffixes to the right and the reversed prefixes to the left of an anchor are sorted. Sorting is
shallow first (multikey, eight bytes at a time); groups that still share all of the shallow depth are ordered by blind
tries. From the common-prefix lengths of both orders follows, for each anchor, which strings around it occur again; all of
them contain the anchor, so their union is one range.

Texts that occur more than once are one text from the start, and all of their bytes repeat. A gram with more than ``HOT``
anchors is not gathered in one task: the strings around its anchors are hashed (128 bits) and counted with map-side
combine instead.

Defined cases: a null text is empty and keeps nothing; texts shorter than SIZE keep all; overlapping and periodic
repetitions count; every row, also one that repeats an id or a text, has a result of its own; an empty table gives no
rows; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from granary.llm.text import BASE_INVERSE, joined, mix, powers, prefix_hash, slabs
from granary.operators.skew import join_unique
from granary.session import materialize

SIZE, GRAM = 200, 64
BEFORE = SIZE - GRAM  # bytes of a string that may stand left of its anchor
HOT = 1 << 15
#: Anchors sorted at a time, and the depth in bytes at which shallow sorting gives way to blind tries.
BLOCK, SHALLOW = 1 << 15, 96
PLACE = np.uint64((1 << 31) - 1)


def gram_hashes(data: np.ndarray) -> np.ndarray:
    prefix = prefix_hash(data)
    n = len(data) - GRAM + 1
    return mix((prefix[GRAM:] - prefix[:n]) * powers(BASE_INVERSE, n)[:n])


def anchors(data: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Text number, place in the text and gram hash of all anchors; texts end one byte before the next one starts."""
    n = len(data) - SIZE + 1
    if n <= 0:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint64)
    grams = gram_hashes(data)
    least = (grams & ~PLACE) | np.arange(len(grams), dtype=np.uint64)  # equal hashes: the first
    width, span = BEFORE + 1, 1
    while 2 * span <= width:
        least = np.minimum(least[:-span], least[span:])
        span *= 2
    least = np.minimum(least[: len(least) - (width - span)], least[width - span :])[:n]
    whole = np.zeros(n + 1, np.int8)  # strings that lie in one text
    lo, hi = starts[:-1], starts[1:] - SIZE
    some = hi > lo
    whole[lo[some]] += 1
    whole[np.minimum(hi[some], n)] -= 1
    at = least[np.cumsum(whole[:-1]) > 0] & PLACE
    at = at[np.append(True, at[1:] != at[:-1])].astype(np.int64) if len(at) else at.astype(np.int64)
    text = np.searchsorted(starts, at, side="right") - 1
    return text, at - starts[text], grams[at]


class BlindTrie:
    """Orders byte strings: an inner node knows the depth at which its strings part, but not what stands before."""

    __slots__ = ("children", "depth")

    def __init__(self, depth: int, children: dict):
        self.depth, self.children = depth, children

    @staticmethod
    def order(strings: list[bytes]) -> tuple[list[int], list[int]]:
        """The sorted order of distinct strings of one length, and how many bytes each shares with the one before it."""
        root: BlindTrie | int = 0
        length = len(strings[0])
        for i in range(1, len(strings)):
            s, node = strings[i], root
            while type(node) is not int:  # blind: to any leaf that the known bytes allow
                node = node.children.get(s[node.depth]) if s[node.depth] in node.children else next(iter(node.children.values()))
            other = strings[node]
            apart = int.from_bytes(s, "big") ^ int.from_bytes(other, "big")
            depth = length - (apart.bit_length() + 7) // 8
            up, node = None, root
            while type(node) is not int and node.depth < depth:
                up, node = node, node.children[s[node.depth]]
            if type(node) is not int and node.depth == depth:
                node.children[s[depth]] = i
                continue
            new = BlindTrie(depth, {s[depth]: i, other[depth]: node})
            if up is None:
                root = new
            else:
                up.children[s[up.depth]] = new
        out, common = [], []
        stack: list[tuple] = [(root, 0)]
        while stack:
            node, shared = stack.pop()
            if type(node) is int:
                out.append(node)
                common.append(shared)
            else:
                branches = sorted(node.children.items(), reverse=True)
                stack += [(child, node.depth) for _, child in branches[:-1]]
                stack.append((branches[-1][1], shared))
        return out, common


def deep_shallow(group: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Order of ``rows`` (bytes) within each ``group`` (ascending numbers), and the bytes shared with the row before; -1 at
    the first row of a group. Equal rows share all their bytes."""
    n, width = rows.shape
    if not n:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    words = np.ascontiguousarray(rows[:, :SHALLOW]).view(">u8").astype(np.uint64)
    order = np.lexsort((*(words[:, j] for j in range(words.shape[1] - 1, -1, -1)), group))
    # bytes shared with the row before, as far as the shallow depth goes
    near = rows[order]
    same = near[1:, :SHALLOW] == near[:-1, :SHALLOW]
    shared = np.where(same.all(axis=1), SHALLOW, same.argmin(axis=1))
    shared = np.concatenate(([-1], np.where(group[order][1:] == group[order][:-1], shared, -1)))
    if width <= SHALLOW:
        return order, shared
    tied = np.concatenate((shared >= SHALLOW, [False]))
    first = np.flatnonzero(tied[1:] & ~tied[:-1])
    last = np.flatnonzero(tied[:-1] & ~tied[1:])
    deep = np.ascontiguousarray(rows[:, SHALLOW:])
    for a, b in zip(first.tolist(), last.tolist(), strict=True):
        of: dict[bytes, list[int]] = {}
        for r in order[a : b + 1].tolist():
            of.setdefault(deep[r].tobytes(), []).append(r)
        strings = list(of)
        ranked, common = BlindTrie.order(strings)
        at = a
        for k, c in zip(ranked, common, strict=True):
            for j, r in enumerate(of[strings[k]]):
                order[at] = r
                if at > a:
                    shared[at] = width if j else SHALLOW + c
                at += 1
    return order, shared


def repeats(group: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For anchors with their surroundings (BEFORE bytes left, SIZE bytes from the anchor; 0 beyond the text): the least and
    the largest number of bytes left of the anchor with which a string occurs again; -1 where none does."""
    left = np.ascontiguousarray(rows[:, :BEFORE][:, ::-1])
    right = np.ascontiguousarray(rows[:, BEFORE:])
    n = len(rows)
    most = np.minimum(BEFORE, (left != 0).sum(axis=1))
    least = SIZE - (right != 0).sum(axis=1)
    by_left, shared_left = deep_shallow(group, left)
    by_right, shared_right = deep_shallow(group, right)
    low, high = np.full(n, -1), np.full(n, -1)

    def again(t: int, who: np.ndarray) -> np.ndarray:
        """Which of the rows ``who`` have a string with ``t`` bytes left of the anchor that another row has too."""
        a, b = np.empty(n, np.int64), np.empty(n, np.int64)
        a[by_left] = np.cumsum(shared_left < t)
        b[by_right] = np.cumsum(shared_right < SIZE - t)
        fits = who & (most >= t) & (least <= t)
        key = a[fits] * (n + 1) + b[fits]
        _, back, count = np.unique(key, return_inverse=True, return_counts=True)
        out = np.zeros(n, bool)
        out[fits] = count[back] > 1
        return out

    _, number = np.unique(group, return_inverse=True)
    for out, turns in ((low, range(BEFORE + 1)), (high, range(BEFORE, -1, -1))):
        open_ = np.ones(n, bool) if out is low else low >= 0
        for t in turns:
            wanted = np.bincount(number[open_], minlength=number[-1] + 1 if n else 0) > 0  # groups that still have questions
            found = again(t, wanted[number]) & open_
            out[found] = t
            open_ &= ~found
            if not open_.any():
                break
    return low, high


def _keyed(docs: DataFrame) -> DataFrame:
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    return docs.select("doc_id", text.alias("text")).select("doc_id", "text", F.octet_length("text").cast("long").alias("n_bytes"), F.xxhash64("text").alias("t1"), F.hash("text").alias("t2"))


def _anchor_rows(texts: DataFrame) -> DataFrame:
    """(h, t1, at) of every anchor; ``at`` holds t2 above and the place below 32 bits."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            t1, t2 = batch.column("t1").to_numpy(), batch.column("t2").to_numpy().astype(np.int64)
            for first, some in slabs(batch, "text", 1 << 20):
                text, place, gram = anchors(*joined(some))
                text = text + first
                yield pa.RecordBatch.from_arrays([pa.array(gram.view(np.int64)), pa.array(t1[text]), pa.array((t2[text] << 32) | place)], names=["h", "t1", "at"])

    return texts.where(F.col("n_bytes") >= SIZE).select("text", "t1", "t2").mapInArrow(run, "h long, t1 long, at long")


def _surroundings(wanted: DataFrame) -> DataFrame:
    """A row per anchor that few share: its gram hash, text, place and bytes around it, as byte values plus one."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for t1, t2, text, places in zip(*(batch.column(c) for c in ("t1", "t2", "text", "places")), strict=True):
                h, at = places.values.field("h"), places.values.field("place").to_numpy()
                if not len(at):
                    continue
                data = np.frombuffer(text.as_buffer(), np.uint8) + 1
                padded = np.concatenate((np.zeros(BEFORE, np.uint8), data, np.zeros(SIZE, np.uint8)))
                rows = np.lib.stride_tricks.sliding_window_view(padded, BEFORE + SIZE)
                for a in range(0, len(at), 1 << 13):
                    here = at[a : a + (1 << 13)]
                    n = len(here)
                    around = pa.Array.from_buffers(pa.binary(), n, [None, pa.py_buffer((np.arange(n + 1) * (BEFORE + SIZE)).astype(np.int32)), pa.py_buffer(rows[here].tobytes())])
                    yield pa.RecordBatch.from_arrays(
                        [h.slice(a, n), pa.array([t1.as_py()] * n, pa.int64()), pa.array([t2.as_py()] * n, pa.int32()), pa.array(here, pa.int32()), around], names=["h", "t1", "t2", "place", "around"]
                    )

    return wanted.mapInArrow(run, "h long, t1 long, t2 int, place int, around binary")


def _sorted_ranges(around: DataFrame) -> DataFrame:
    """(t1, t2, lo, hi) of the bytes around each anchor that occur again."""

    def block(batches: list[pa.RecordBatch]) -> pa.RecordBatch:
        table = pa.Table.from_batches(batches).combine_chunks()
        rows = np.frombuffer(b"".join(table.column("around").to_pylist()), np.uint8).reshape(table.num_rows, BEFORE + SIZE)
        low, high = repeats(table.column("h").to_numpy(), rows)
        place = table.column("place").to_numpy().astype(np.int64)
        good = pa.array(low >= 0)
        kept = [table.column(c).combine_chunks() for c in ("t1", "t2")]
        kept += [pa.array(place - high), pa.array(place - low + SIZE)]
        return pa.RecordBatch.from_arrays([c.filter(good) for c in kept], names=["t1", "t2", "lo", "hi"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        n = 0
        for batch in batches:
            h = batch.column("h").to_numpy()
            cuts = np.flatnonzero(np.append(not held or h[0] != held[-1].column("h")[-1].as_py(), h[1:] != h[:-1])) if len(h) else []
            at = 0
            for cut in cuts:  # a new gram starts here: what is held is whole
                if n + cut - at >= BLOCK:
                    held.append(batch.slice(at, cut - at))
                    yield block(held)
                    held, n, at = [], 0, cut
            if batch.num_rows > at:
                held.append(batch.slice(at))
                n += batch.num_rows - at
        if held:
            yield block(held)

    return around.repartition("h").sortWithinPartitions("h").mapInArrow(run, "t1 long, t2 int, lo long, hi long")


def _counted_ranges(wanted: DataFrame) -> DataFrame:
    """The same for grams that very many anchors share: the strings around them, hashed and counted."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for t1, t2, text, places in zip(*(batch.column(c) for c in ("t1", "t2", "text", "hot")), strict=True):
                at = places.values.to_numpy()
                data = np.frombuffer(text.as_buffer(), np.uint8)
                mark = np.zeros(len(data) + 1, np.int64)
                np.add.at(mark, np.maximum(at - BEFORE, 0), 1)
                np.add.at(mark, np.minimum(at, len(data) - SIZE) + 1, -1)
                start = np.flatnonzero(np.cumsum(mark[: len(data) - SIZE + 1]))
                if not len(start):
                    continue
                digests = np.empty((2, len(start)), np.uint64)
                for j, d in enumerate((data, data[::-1])):  # the second hash runs backwards
                    prefix, s = prefix_hash(d), start if j == 0 else len(data) - SIZE - start
                    digests[j] = mix((prefix[s + SIZE] - prefix[s]) * powers(BASE_INVERSE, len(data))[s])
                n = len(start)
                yield pa.RecordBatch.from_arrays(
                    [*(pa.array(x.view(np.int64)) for x in digests), pa.array([t1.as_py()] * n, pa.int64()), pa.array([t2.as_py()] * n, pa.int32()), pa.array(start, pa.int64())],
                    names=["w1", "w2", "t1", "t2", "lo"],
                )

    strings = materialize(wanted.where(F.size("hot") > 0).select("t1", "t2", "text", "hot").mapInArrow(run, "w1 long, w2 long, t1 long, t2 int, lo long"), "strings")
    where = F.xxhash64("t1", "t2", "lo")
    twice = strings.groupBy("w1", "w2").agg(F.min(where).alias("x"), F.max(where).alias("y")).where("x < y").select("w1", "w2")
    twice = materialize(twice, "strings")
    return strings.join(twice, ["w1", "w2"], "left_semi").select("t1", "t2", "lo", (F.col("lo") + SIZE).alias("hi"))


def repeated_ranges(docs: DataFrame, hot: int = HOT) -> tuple[DataFrame, DataFrame]:
    """Distinct texts with an anchor that occurs again (t1, t2, text), written once, and the ranges (t1, t2, lo, hi) of
    their bytes that strings of SIZE bytes found elsewhere cover."""
    texts = _keyed(docs)
    rows = materialize(_anchor_rows(texts), "anchors")
    where = F.xxhash64("t1", "at")
    # an anchor of a copied text comes as often as its copies; only another text or place makes a gram occur again
    twice = rows.groupBy("h").agg(F.min(where).alias("x"), F.max(where).alias("y")).where("x < y").select("h")
    live = materialize(join_unique(rows, twice, ["h"], "left_semi").distinct(), "anchors")
    # written first, so that the planner knows how few they are and adaptive execution may split what they meet
    many = materialize(live.groupBy("h").count().where(F.col("count") > hot).select("h", F.lit(True).alias("many")), "hot-grams")
    flagged = live.join(many, "h", "left").withColumn("many", F.coalesce("many", F.lit(False)))
    place, t2 = F.col("at").bitwiseAND(0xFFFFFFFF).cast("int"), F.shiftright("at", 32).cast("int")
    spots = flagged.groupBy("t1", t2.alias("t2")).agg(
        F.collect_list(F.when(~F.col("many"), F.struct("h", place.alias("place")))).alias("places"), F.collect_list(F.when(F.col("many"), place)).alias("hot")
    )
    distinct = texts.where(F.col("n_bytes") >= SIZE).groupBy("t1", "t2").agg(F.first("text").alias("text"))
    wanted = materialize(distinct.join(spots, ["t1", "t2"]), "texts")
    ranges = _sorted_ranges(_surroundings(wanted)).union(_counted_ranges(wanted))
    return wanted.select("t1", "t2", "text"), ranges


def remove_repeats(docs: DataFrame, hot: int = HOT) -> DataFrame:
    """Per row: doc_id, n_bytes, n_removed, n_spans, kept_sha256 and ``spans`` (start, end in bytes) of what is removed."""
    wanted, ranges = repeated_ranges(docs, hot)
    kind = "array<struct<start:long,end:long>>"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            removed, spans, sha = [], [], []
            for text, ranges_ in zip(batch.column("text"), batch.column("ranges").to_pylist(), strict=True):
                data = text.as_buffer().to_pybytes()
                merged: list[list[int]] = []
                for r in sorted(ranges_, key=lambda r: (r["lo"], r["hi"])):
                    if merged and r["lo"] <= merged[-1][1]:
                        merged[-1][1] = max(merged[-1][1], r["hi"])
                    else:
                        merged.append([r["lo"], r["hi"]])
                kept, at = hashlib.sha256(), 0
                for a, b in merged:
                    kept.update(data[at:a])
                    at = b
                kept.update(data[at:])
                removed.append(sum(b - a for a, b in merged))
                spans.append([{"start": a, "end": b} for a, b in merged])
                sha.append(kept.hexdigest())
            yield pa.RecordBatch.from_arrays(
                [batch.column("t1"), batch.column("t2"), pa.array(removed, pa.int64()), pa.array(sha, pa.string()), pa.array(spans, pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())])))],
                names=["t1", "t2", "n_removed", "kept", "spans"],
            )

    by_text = ranges.groupBy("t1", "t2").agg(F.collect_list(F.struct("lo", "hi")).alias("ranges"))
    cut = wanted.join(by_text, ["t1", "t2"]).mapInArrow(run, f"t1 long, t2 int, n_removed long, kept string, spans {kind}")
    own = _keyed(docs).select("doc_id", "n_bytes", "t1", "t2", F.sha2("text", 256).alias("whole"))
    copied = own.where(F.col("n_bytes") >= SIZE).groupBy("t1", "t2").count().where("count > 1").select("t1", "t2", F.lit(True).alias("copied"))
    done = own.join(cut, ["t1", "t2"], "left").join(copied, ["t1", "t2"], "left")
    every = F.array(F.struct(F.lit(0).cast("long").alias("start"), F.col("n_bytes").alias("end")))
    done = done.withColumn("spans", F.when(F.col("copied"), every).otherwise(F.coalesce("spans", F.array().cast(kind))))
    return done.select(
        "doc_id",
        "n_bytes",
        F.when(F.col("copied"), F.col("n_bytes")).otherwise(F.coalesce("n_removed", F.lit(0))).cast("long").alias("n_removed"),
        F.size("spans").cast("long").alias("n_spans"),
        F.when(F.col("copied"), F.sha2(F.lit(""), 256)).otherwise(F.coalesce("kept", "whole")).alias("kept_sha256"),
        "spans",
    )
