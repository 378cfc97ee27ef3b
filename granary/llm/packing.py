"""Best-fit packing with large-item matching.

A sequence holds ``capacity`` tokens, so pieces fall into at most ``capacity`` lengths. Their counts, one per length, fix
the best-fit packing of all documents at once: lengths above a third of the capacity meet at most twice in a sequence and
are matched greedily, the longest with the longest that still fits; shorter lengths go, longest first, to the smallest gap
that takes them. The plan is a list of at most a few times ``capacity`` groups of equal sequences, whatever the number of
documents. Each piece then finds its place by its rank among the pieces of its length; ranks are counted in runs of
bounded size, so a length that a third of all pieces share is spread over many tasks.

Defined cases: a null or empty text is its closing id alone; every row is packed, repeated rows and ids as often as they
come; ties between pieces of one length are resolved by any order; an empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

import base64
import zlib
from bisect import bisect_left, insort
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from granary.llm.text import mix
from granary.session import materialize

CAPACITY = 2048
#: Pieces per ranked run.
RUN = 1024


def tokenizer(ranks_file: str, pattern: str):
    """Byte-pair encoder of a rank file; strings of special tokens are ordinary text."""
    import tiktoken

    with open(ranks_file, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("packing", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


def cut(docs: DataFrame, ranks_file: str, pattern: str, end_id: int = 0, capacity: int = CAPACITY, keep_ids: bool = False) -> DataFrame:
    """A row per piece of at most ``capacity`` ids: doc_id, piece, start, length, ids_crc32 and, if asked for, ids.

    Only the first piece of a longer document is shorter. ``spot`` is a number for spreading, fixed by the row's place.
    """
    schema = f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, piece int, start long, length long, ids_crc32 long, spot long"
    schema += ", ids array<int>" if keep_ids else ""

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = tokenizer(ranks_file, pattern)
        part, seen = TaskContext.get().partitionId(), 0
        for batch in batches:
            rows: list[tuple] = []
            kept: list[np.ndarray] = []
            for doc, text in zip(batch.column("doc_id"), batch.column("text"), strict=True):
                ids = np.array([*known.encode_ordinary(text.as_py() or ""), end_id], "<u4")
                bounds = [0, *range(len(ids) % capacity or capacity, len(ids) + 1, capacity)]
                for k, (a, b) in enumerate(zip(bounds, bounds[1:], strict=False)):
                    rows.append((doc, k, a, b - a, zlib.crc32(ids[a:b].tobytes())))
                    if keep_ids:
                        kept.append(ids[a:b].astype(np.int32))
            if not rows:
                continue
            spot = mix(np.arange(seen, seen + len(rows), dtype=np.uint64) * np.uint64(1 << 22) + np.uint64(part)) >> np.uint64(1)
            seen += len(rows)
            docs_, piece, start, length, crc = zip(*rows, strict=True)
            out = [pa.array([d.as_py() for d in docs_], batch.schema.field("doc_id").type), pa.array(piece, pa.int32())]
            out += [pa.array(x, pa.int64()) for x in (start, length, crc, spot.astype(np.int64))]
            names = ["doc_id", "piece", "start", "length", "ids_crc32", "spot"]
            if keep_ids:
                out, names = [*out, pa.array(kept, pa.list_(pa.int32()))], [*names, "ids"]
            yield pa.RecordBatch.from_arrays(out, names=names)

    return docs.select("doc_id", "text").mapInArrow(encode, schema)


@dataclass
class Group:
    """``count`` sequences that hold the same lengths."""

    count: int
    gap: int
    items: list[tuple[int, int]] = field(default_factory=list)  # (length, how many of it in each sequence)

    def with_items(self, count: int, length: int, times: int) -> Group:
        return Group(count, self.gap - length * times, [*self.items, (length, times)])


def plan(counts: dict[int, int], capacity: int = CAPACITY) -> list[Group]:
    """Groups of sequences for so many pieces of each length."""
    left, groups = dict(counts), []
    large = sorted(n for n in left if 3 * n > capacity and left[n])
    while large:
        longest = large[-1]
        # the longest partner that fits and is still there; a length may meet itself
        at = bisect_left(large, capacity - longest + 1) - 1
        while at >= 0 and large[at] == longest and left[longest] < 2:
            at -= 1
        if at < 0:
            groups.append(Group(left[longest], capacity, []).with_items(left[longest], longest, 1))
            left[longest] = 0
        elif large[at] == longest:
            n = left[longest] // 2
            groups.append(Group(n, capacity).with_items(n, longest, 2))
            left[longest] -= 2 * n
        else:
            n = min(left[longest], left[large[at]])
            groups.append(Group(n, capacity).with_items(n, longest, 1).with_items(n, large[at], 1))
            left[longest] -= n
            left[large[at]] -= n
        large = [n for n in large if left[n]]
    gaps: list[tuple[int, int]] = []  # (gap, number of the group), sorted
    for g, group in enumerate(groups):
        if group.gap:
            insort(gaps, (group.gap, g))
    for length in sorted((n for n in left if left[n]), reverse=True):
        while left[length]:
            at = bisect_left(gaps, (length, 0))
            if at == len(gaps):
                times = min(capacity // length, left[length])
                n = left[length] // times
                groups.append(Group(n, capacity).with_items(n, length, times))
                left[length] -= n * times
            else:
                g = gaps.pop(at)[1]
                old = groups[g]
                times = min(old.gap // length, left[length])
                n = min(old.count, left[length] // times)
                groups[g] = old.with_items(n, length, times)
                left[length] -= n * times
                if n < old.count:
                    groups.append(Group(old.count - n, old.gap, list(old.items)))
                    insort(gaps, (old.gap, len(groups) - 1))
                if groups[g].gap:
                    insort(gaps, (groups[g].gap, g))
                continue
            if groups[-1].gap:
                insort(gaps, (groups[-1].gap, len(groups) - 1))
    return groups


def slots(groups: list[Group], capacity: int = CAPACITY) -> pd.DataFrame:
    """For each length, which ranks go where: from rank ``first`` on, ``times`` to a sequence, from sequence ``base`` on."""
    taken: dict[int, int] = {}
    rows, base = [], 0
    for group in groups:
        offset = 0
        for length, times in group.items:
            first = taken.get(length, 0)
            rows.append((length, first, times, base, offset))
            taken[length] = first + times * group.count
            offset += length * times
        base += group.count
    out = pd.DataFrame(rows, columns=["length", "first", "times", "base", "offset"], dtype="int64")
    return out.sort_values(["length", "first"], ignore_index=True)


def pack(pieces: DataFrame, capacity: int = CAPACITY, run: int = RUN) -> DataFrame:
    """``pieces`` (as ``cut`` gives them, already written) with ``sequence_id`` and ``offset``."""
    counts = {r["length"]: r["count"] for r in pieces.groupBy("length").count().collect()}  # at most ``capacity`` rows
    places = slots(plan(counts, capacity), capacity)
    lengths, first = places["length"].to_numpy(), places["first"].to_numpy()
    times, base, offset = (places[c].to_numpy() for c in ("times", "base", "offset"))
    runs = ",".join(str(-(-counts.get(n, 0) // run) or 1) for n in range(capacity + 1))
    held = pieces.withColumn("run", F.expr(f"cast(pmod(spot, element_at(array({runs}), cast(length as int) + 1)) as int)"))
    sizes = held.groupBy("length", "run").count()
    earlier = Window.partitionBy("length").orderBy("run").rowsBetween(Window.unboundedPreceding, -1)
    before = F.sum("count").over(earlier)
    before = sizes.select("length", "run", F.coalesce(before, F.lit(0)).alias("before"))
    inside = F.row_number().over(Window.partitionBy("length", "run").orderBy("spot"))
    ranked = held.withColumn("inside", inside).join(before, ["length", "run"])
    ranked = ranked.withColumn("rank", F.col("before") + F.col("inside") - 1).drop("run", "spot", "inside", "before")

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        low = np.searchsorted(lengths, np.arange(capacity + 2))
        for batch in batches:
            n, rank = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("length", "rank"))
            at = np.empty(len(n), np.int64)
            for v in np.unique(n):
                mine = n == v
                at[mine] = low[v] + np.searchsorted(first[low[v] : low[v + 1]], rank[mine], side="right") - 1
            nth = rank - first[at]
            out = {c: batch.column(c) for c in batch.schema.names if c != "rank"}
            out |= {"sequence_id": pa.array(base[at] + nth // times[at]), "offset": pa.array(offset[at] + nth % times[at] * n)}
            yield pa.RecordBatch.from_pydict(out)

    fields = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in ranked.schema if f.name != "rank")
    return ranked.mapInArrow(place, f"{fields}, sequence_id long, offset long")


def pack_documents(docs: DataFrame, ranks_file: str, pattern: str, capacity: int = CAPACITY, keep_ids: bool = False) -> DataFrame:
    """All of ``docs`` as pieces with their places. The pieces are written once, so that each has one rank."""
    pieces = materialize(cut(docs, ranks_file, pattern, capacity=capacity, keep_ids=keep_ids), "pieces")
    return pack(pieces, capacity)
