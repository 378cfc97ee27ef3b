"""N-gram Jaccard join by parity sketches.

A document is the set of its distinct word shingles, hashed to 64 bits. The XOR of hashes is a parity sketch: two sets
whose symmetric difference has d elements differ in at most d of the parts into which a hash splits them. Sets are put
into size bands. For a band, d is known for every pair that links, so d + 1 parts, and some more for parts that stay empty,
always leave one part alike: the parts' XORs are the join keys. A longer parity sketch of bits, one XOR bit per hash,
gives a lower bound of the symmetric difference for what the keys let through, and exact set sizes decide.

Only components are asked for, so pairs are not listed within a key: first each key's members are compared with the
member that shares most keys, the links found are closed to components, and only keys whose members still fall into
several components compare these with each other, in blocks. Equal sets are one node from the start. No link between
different texts is lost: every linked pair shares a key, and it is either compared or already in one component.

Defined cases: a null text, or one without words, has no shingles and links with nothing; a text of fewer words than a
shingle is one shingle; a row without ``doc_id`` keeps an empty component; repeated rows are equal sets; ties do not
occur (limits are whole numbers); an empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

import bisect
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from granary.llm.graph import components
from granary.llm.text import BASE, NONSPACE, Words, mix, slabs
from granary.operators.skew import join_unique
from granary.session import discard, materialize

#: Keys that a task of the key stage holds, and members of a key that one task compares with each other.
TASK_KEYS, BLOCK = 1 << 22, 8192
#: Lower bounds of the size bands, a factor of 1.5 apart.
BANDS = [1]
while BANDS[-1] < 1 << 40:
    BANDS.append(max(BANDS[-1] + 1, BANDS[-1] * 3 // 2))


def band_of(size: int) -> int:
    return bisect.bisect_right(BANDS, size) - 1


def most_apart(size: int, percent: int) -> int:
    """Largest symmetric difference of a linked pair whose smaller set has ``size`` elements."""
    return (100 - percent) * (100 * size // percent) // 100


def parts_of(band: int, percent: int) -> tuple[int, int]:
    """Number of parts in a band, and how many of them a linked pair of its largest sets shares at least."""
    apart = most_apart(BANDS[band + 1] - 1, percent)
    more = 2 + apart // 16
    return apart + more, more


KEY_BYTES = 6


def shingle_sets(texts: list[str | None], n: int) -> list[np.ndarray]:
    """The distinct shingle hashes of each text, sorted."""
    words = Words(texts, NONSPACE)
    hashes, _ = words.grams(n)
    out = []
    for lo, hi in zip(words.first.tolist(), words.first[1:].tolist(), strict=False):
        if hi - lo >= n:
            out.append(np.unique(hashes[lo : hi - n + 1]))
        elif hi > lo:
            h = np.zeros(1, np.uint64)
            for x in words.hash[lo:hi]:
                h = h * BASE + x
            out.append(mix(h + np.uint64(hi - lo)))
        else:
            out.append(np.zeros(0, np.uint64))
    return out


def digest(hashes: np.ndarray) -> tuple[int, int]:
    """Two 64-bit values that equal sets share."""
    a = mix(hashes ^ BASE).sum(dtype=np.uint64)
    b = np.bitwise_xor.reduce(mix(hashes + np.uint64(len(hashes)))) if len(hashes) else np.uint64(0)
    return int(mix(a.reshape(1)).view(np.int64)[0]), int(np.uint64(b).view(np.int64))


def keys(hashes: np.ndarray, percent: int) -> np.ndarray:
    """Join keys of a set, one per part, KEY_BYTES each: in its own band and in those of smaller sets that may link with it.

    Of its own band's parts it needs only the first few: a pair whose smaller set has n elements differs in at most
    most_apart(n) parts, so among that many and ``shared`` more, which both sets have keys of, ``shared`` are alike.
    """
    n, out = len(hashes), []
    mixed = mix(hashes * np.uint64(3))
    for band in range(band_of(-(-percent * n // 100)), band_of(n) + 1):
        parts, shared = parts_of(band, percent)
        part = (mixed >> np.uint64(32)) % np.uint64(parts)
        needed = min(parts, most_apart(n, percent) + shared)
        order = part.argsort(kind="stable")
        there, start = np.unique(part[order], return_index=True)
        value = np.bitwise_xor.reduceat(hashes[order], start)
        there, value = there[there < needed], value[there < needed]
        if needed - len(there) >= shared:  # only then may all shared parts be empty
            empty = np.setdiff1d(np.arange(needed, dtype=np.uint64), there)
            there, value = np.concatenate((there, empty)), np.concatenate((value, np.zeros(len(empty), np.uint64)))
        out.append(mix(value ^ mix(there * np.uint64(1 << 20) + np.uint64(band + 1))))
    short = np.concatenate(out).astype("<u8").view(np.uint8).reshape(-1, 8)
    return np.ascontiguousarray(short[:, :KEY_BYTES])


def sketch(hashes: np.ndarray) -> bytes:
    """Parity bits, as many as the next power of two of four times the set size, so that few of them cancel out; halves of a
    sketch XOR to the shorter sketch."""
    bits = max(64, 1 << (4 * len(hashes) - 1).bit_length())
    odd = np.bincount((mix(hashes * np.uint64(5)) & np.uint64(bits - 1)).astype(np.int64), minlength=bits) & 1
    return np.packbits(odd.astype(np.uint8)).tobytes()


def fold(bits: np.ndarray, size: int) -> np.ndarray:
    while bits.shape[-1] > size:
        half = bits.shape[-1] // 2
        bits = bits[..., :half] ^ bits[..., half:]
    return bits


def describe(docs: DataFrame, n: int, percent: int) -> DataFrame:
    """doc_id, text_hash, n_shingles, set (id of the set), other (its second digest), keys and sketch of every row."""
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, texts in slabs(batch, "text"):
                sets = shingle_sets(texts, n)
                told = [digest(s) for s in sets]
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("doc_id").slice(first, len(texts)),
                        batch.column("text_hash").slice(first, len(texts)),
                        pa.array([len(s) for s in sets], pa.int64()),
                        pa.array([t[0] for t in told], pa.int64()),
                        pa.array([t[1] for t in told], pa.int64()),
                        pa.array([keys(s, percent).tobytes() if len(s) else None for s in sets], pa.binary()),
                        pa.array([sketch(s) if len(s) else None for s in sets], pa.binary()),
                    ],
                    names=["doc_id", "text_hash", "n_shingles", "set", "other", "keys", "sketch"],
                )

    return docs.select("doc_id", "text", F.xxhash64("text").alias("text_hash")).mapInArrow(run, f"doc_id {kind}, text_hash long, n_shingles long, set long, other long, keys binary, sketch binary")


def shared_keys(sets: DataFrame, task_keys: int = TASK_KEYS) -> DataFrame:
    """(key, set) for keys that several sets have. Keys travel packed by part of the key space; there are as many tasks, and
    four parts for each, as the number of keys asks for."""
    total = sets.agg(F.sum(F.octet_length("keys"))).first()[0] or 0
    tasks = max(int(sets.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-total // (KEY_BYTES * task_keys)))
    splits = np.uint32(4 * tasks)

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            each = [np.frombuffer(k, np.uint8).reshape(-1, KEY_BYTES) for k in batch.column("keys").to_pylist()]
            if not each:
                continue
            both = np.empty((sum(map(len, each)), KEY_BYTES + 8), np.uint8)
            both[:, :KEY_BYTES] = np.concatenate(each)
            both[:, KEY_BYTES:] = np.repeat(batch.column("set").to_numpy(), [len(x) for x in each]).view(np.uint8).reshape(-1, 8)
            split = both[:, :4].copy().view("<u4").ravel() % splits
            order = split.argsort(kind="stable")
            both, split = both[order], split[order]
            there, start = np.unique(split, return_index=True)
            ends = np.append(start[1:], len(both))
            yield pa.RecordBatch.from_arrays(
                [pa.array(there.astype(np.int32)), pa.array([both[a:b].tobytes() for a, b in zip(start, ends, strict=True)], pa.binary())], names=["split", "pairs"]
            )

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [np.frombuffer(x.as_buffer(), np.uint8).reshape(-1, KEY_BYTES + 8) for batch in batches for x in batch.column("pairs")]
        if not held:
            return
        raw = np.concatenate(held)
        held.clear()
        step = 256 if len(raw) < 1 << 20 else 16  # a slice of the keys at a time, by a byte that says nothing about the part
        for low in range(0, 256, step):
            some = raw[(raw[:, KEY_BYTES - 1] >= low) & (raw[:, KEY_BYTES - 1] < low + step)]
            if not len(some):
                continue
            wide = np.zeros((len(some), 16), np.uint8)
            wide[:, :KEY_BYTES], wide[:, 8:] = some[:, :KEY_BYTES], some[:, KEY_BYTES:]
            mine = wide.view("<u8")
            mine = mine[np.lexsort((mine[:, 1], mine[:, 0]))]
            mine = mine[np.append(True, (mine[1:] != mine[:-1]).any(axis=1))]
            same = mine[1:, 0] == mine[:-1, 0]
            mine = mine[np.append(same, False) | np.append(False, same)]
            for a in range(0, len(mine), 1 << 16):
                part = mine[a : a + (1 << 16)].view(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(part[:, 0].copy()), pa.array(part[:, 1].copy())], names=["key", "set"])

    packed = sets.select("set", "keys").mapInArrow(pack, "split int, pairs binary")
    return packed.repartition(tasks, "split").mapInArrow(meet, "key long, set long")


def verify(pairs: DataFrame, texts: DataFrame, n: int, percent: int) -> DataFrame:
    """Those of ``pairs`` (a, b) whose sets, made from ``texts`` (set, text), link."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b = batch.column("a"), batch.column("b")
            right = batch.column(batch.schema.get_field_index("text_b")).to_pylist()
            for first, left in slabs(batch, "text_a", 1 << 20):
                ours, theirs = shingle_sets(left, n), shingle_sets(right[first : first + len(left)], n)
                good = []
                for x, y in zip(ours, theirs, strict=True):
                    common = len(np.intersect1d(x, y, assume_unique=True))
                    good.append(100 * common >= percent * (len(x) + len(y) - common) and common > 0)
                good = pa.array(good)
                yield pa.RecordBatch.from_arrays([a.slice(first, len(left)).filter(good), b.slice(first, len(left)).filter(good)], names=["a", "b"])

    left = texts.select(F.col("set").alias("a"), F.col("text").alias("text_a"))
    right = texts.select(F.col("set").alias("b"), F.col("text").alias("text_b"))
    return pairs.join(left, "a").join(right, "b").select("a", "b", "text_a", "text_b").mapInArrow(run, "a long, b long")


def plausible(pairs: DataFrame, held: DataFrame, percent: int) -> DataFrame:
    """Those of ``pairs`` (a, b) that sizes and sketches in ``held`` (set, n_shingles, sketch) allow to link."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            good = []
            for n, m, x, y in zip(*(batch.column(c).to_pylist() for c in ("n_a", "n_b", "s_a", "s_b")), strict=True):
                x, y = np.frombuffer(x, np.uint8), np.frombuffer(y, np.uint8)
                width = min(len(x), len(y))
                apart = int(np.bitwise_count(fold(x, width) ^ fold(y, width)).sum(dtype=np.int64))
                good.append(100 * (n + m - apart) >= percent * (n + m + apart))
            yield pa.RecordBatch.from_arrays([batch.column("a").filter(pa.array(good)), batch.column("b").filter(pa.array(good))], names=["a", "b"])

    def side(x: str) -> DataFrame:
        return held.select(F.col("set").alias(x), F.col("n_shingles").alias(f"n_{x}"), F.col("sketch").alias(f"s_{x}"))

    joined = pairs.join(side("a"), "a").join(side("b"), "b")
    joined = joined.where(f"100 * least(n_a, n_b) >= {percent} * greatest(n_a, n_b)")
    return joined.select("a", "b", "n_a", "n_b", "s_a", "s_b").mapInArrow(run, "a long, b long")


def close_pairs(members: DataFrame, percent: int, block: int = BLOCK) -> DataFrame:
    """Pairs of ``members`` (key, set, component, n_shingles, sketch) of one key but several components that their sizes and
    sketches allow to link. A key with more than ``block`` members is dealt to tasks by pairs of its blocks."""
    counts = members.groupBy("key").agg(F.count("*").alias("n"), F.min("component").alias("lo"), F.max("component").alias("hi"))
    open_ = members.join(counts.where("lo < hi").select("key", F.ceil(F.col("n") / block).cast("int").alias("blocks")), "key")
    own = F.pmod(F.xxhash64("set"), F.col("blocks")).cast("int")
    cell = F.transform(F.sequence(F.lit(0), F.col("blocks") - 1), lambda j: F.struct(F.least(own, j).alias("p"), F.greatest(own, j).alias("q")))
    dealt = open_.withColumn("own", own).withColumn("cell", F.explode(cell)).select("key", "cell.p", "cell.q", "own", "set", "component", "n_shingles", "sketch")
    dealt = dealt.repartition("key", "p", "q").sortWithinPartitions("key", "p", "q")

    def compare(group: list[tuple]) -> Iterator[tuple[int, int]]:
        _, p, q, own, sets, comp, size, sketches = zip(*group, strict=True)
        own, comp, size, sets = np.array(own), np.array(comp), np.array(size), np.array(sets)
        width = min(map(len, sketches))
        bits = np.stack([fold(np.frombuffer(s, np.uint8), width) for s in sketches]).view(np.uint64 if width % 8 == 0 else np.uint8)
        for i in range(len(sets)):
            j = np.arange(i + 1, len(sets))
            j = j[comp[j] != comp[i]]
            if p[0] != q[0]:
                j = j[own[j] != own[i]]
            small, large = np.minimum(size[j], size[i]), np.maximum(size[j], size[i])
            j = j[100 * small >= percent * large]
            if len(j):
                # 100 * common >= percent * union, with common and union from sizes and a least symmetric difference
                apart = np.bitwise_count(bits[j] ^ bits[i]).sum(axis=1, dtype=np.int64)
                total = size[j] + size[i]
                j = j[100 * (total - apart) >= percent * (total + apart)]
                yield from ((min(sets[i], x), max(sets[i], x)) for x in sets[j])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group: list[tuple] = []
        found: set[tuple[int, int]] = set()

        def out() -> pa.RecordBatch:
            a, b = zip(*found, strict=True)
            found.clear()
            return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])

        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if group and row[:3] != group[0][:3]:
                    found.update(compare(group))
                    group = []
                    if len(found) > 1 << 16:
                        yield out()
                group.append(row)
        if group:
            found.update(compare(group))
        if found:
            yield out()

    return dealt.mapInArrow(run, "a long, b long").distinct()


def _linked(docs: DataFrame, n: int, percent: int) -> DataFrame:
    """doc_id, text_hash, n_shingles and component (named by one of its sets) of every row of ``docs``."""
    rows = materialize(describe(docs, n, percent), "sets")
    slim = materialize(rows.select("doc_id", "text_hash", "n_shingles", "set"), "ids")
    some = rows.where((F.col("n_shingles") > 0) & F.col("doc_id").isNotNull())
    # equal sets are one row from here on; copies meet before the shuffle
    sets = some.groupBy("set", "other").agg(F.min("doc_id").alias("doc_id"), F.first("n_shingles").alias("n_shingles"), F.first("keys").alias("keys"), F.first("sketch").alias("sketch"))
    # written, so that joins to it deal both sides anew and a centre of many pairs can be split
    held = materialize(some.groupBy("set").agg(F.first("n_shingles").alias("n_shingles"), F.first("sketch").alias("sketch")), "sketches")
    shared = materialize(shared_keys(sets), "keys")
    discard(rows)
    some = slim.where((F.col("n_shingles") > 0) & F.col("doc_id").isNotNull())
    degree = shared.groupBy("set").agg(F.count("*").alias("degree"))
    members = shared.join(degree, "set")
    centre = members.groupBy("key").agg(F.max(F.struct("degree", "set")).alias("top")).select("key", F.col("top.set").alias("centre"))
    stars = members.join(centre, "key").where("set <> centre").select(F.least("set", "centre").alias("a"), F.greatest("set", "centre").alias("b")).distinct()
    stars = materialize(plausible(stars, held, percent), "stars")
    links = _verified(docs, some, stars, n, percent)
    known = components(links)
    named = shared.join(known.withColumnRenamed("node", "set"), "set", "left").withColumn("component", F.coalesce("component", "set"))
    several = named.groupBy("key").agg(F.min("component").alias("lo"), F.max("component").alias("hi"), F.count("*").alias("n"))
    several = several.where("lo < hi and n > 2").select("key")  # the one pair of two members has been compared
    open_ = named.join(several, "key").join(held, "set")
    more = materialize(close_pairs(open_, percent).join(stars, ["a", "b"], "left_anti"), "pairs")
    more = _verified(docs, some, more, n, percent)
    final = components(links.union(more)).withColumnRenamed("node", "set")
    discard(shared, stars, held)
    named = join_unique(slim, final, ["set"], "left")
    return named.select("doc_id", "text_hash", "n_shingles", F.coalesce("component", "set").alias("component"))


def link_documents(docs: DataFrame, n: int = 5, percent: int = 80) -> DataFrame:
    """``doc_id``, ``n_shingles`` and ``component_id``, the least doc_id that links lead to, for every row of ``docs``."""
    of = _linked(docs, n, percent)
    least = of.where("n_shingles > 0").groupBy("component").agg(F.min("doc_id").alias("least"))
    joined = join_unique(of, least, ["component"], "left")
    linked = (F.col("n_shingles") > 0) & F.col("doc_id").isNotNull()
    return joined.select("doc_id", "n_shingles", F.when(linked, F.col("least")).otherwise(F.col("doc_id")).alias("component_id"))


def sets_texts(docs: DataFrame, some: DataFrame, pairs: DataFrame) -> DataFrame:
    """(set, text) for all sets in ``pairs``, from the document with the least id that has the set, written once."""
    wanted = pairs.select(F.col("a").alias("set")).union(pairs.select("b")).distinct()
    who = materialize(some.join(wanted, "set", "left_semi").groupBy("set").agg(F.min("doc_id").alias("doc_id")), "ids")
    texts = materialize(docs.select("doc_id", "text").join(who, "doc_id").select("set", "text"), "texts")
    discard(who)
    return texts


def _verified(docs: DataFrame, some: DataFrame, pairs: DataFrame, n: int, percent: int) -> DataFrame:
    """``verify`` on texts that are written for it and deleted after it."""
    texts = sets_texts(docs, some, pairs)
    links = materialize(verify(pairs, texts, n, percent), "links")
    discard(texts)
    return links


def keep_one(docs: DataFrame, n: int = 5, percent: int = 80) -> DataFrame:
    """One row of each component: of the least id and, where rows repeat this id, of the text that hashes lowest. Rows
    without id or words stay, as they are linked with nothing."""
    alone = F.col("doc_id").isNull() | ~F.coalesce(F.col("text").rlike(r"[^\x20\x09-\x0D]"), F.lit(False))
    linked = _linked(docs, n, percent).where((F.col("n_shingles") > 0) & F.col("doc_id").isNotNull())
    kept = linked.groupBy("component").agg(F.min(F.struct("doc_id", "text_hash")).alias("one")).select(F.col("one.doc_id").alias("_id"), F.col("one.text_hash").alias("_hash"))
    rows = docs.where(~alone).select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"), F.col("doc_id").alias("_own"), F.xxhash64("text").alias("_own_hash"))
    found = rows.join(kept, (F.col("_own") == F.col("_id")) & (F.col("_own_hash") == F.col("_hash")))
    # equal rows of the kept id have met in one task by now
    single = found.groupBy("_id", "_hash").agg(F.first("_row").alias("_row")).select("_row.*")
    return docs.where(alone).unionByName(single)
