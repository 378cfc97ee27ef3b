"""Phrase collocations by set-oriented relational mining (SETM).

Occurrences are a relation of (piece, position, group), persisted and sorted. The relation of k words is merge-joined with
itself on piece and adjacent position, which gives the candidates of k + 1 words; their groups are counted over the whole
corpus; groups below the least count are removed by a semi-join before the next length.

A row per occurrence would move every word of the corpus through several shuffles. So the relation is kept by blocks of about
``BLOCK`` words: a block's occurrences stand in one row as two sorted columns (position and group; a piece ends where a
position is left out), groups numbered within the block. The merge join is a comparison of neighbours there. What Spark
shuffles are the groups of each block with their counts, once per length: they are dealt out by a hash, packed by block and part,
and equal groups meet in one part. A part answers each block with one packed row, the numbers of the block's frequent groups and
their names, and lists each frequent group once. A group is known across blocks by its parts (the two overlapping phrases that
make it; at the start language and word) and is named by the least (block, number) that holds it. No hashes stand for words.

Hot groups: a word or phrase has one entry per block, however often it occurs; a language may hold all rows, since nothing is
gathered by language but the best of each of ``TOP_PARTS`` parts. Every relation is written to the shared folder, so a lost
executor repeats one step, not the chain.

Defined cases: a null or empty text has no words; a null language is ``und``; repeated rows and ids count as often as they
come; equal scores are ordered by count, then by the phrase's bytes; an empty table gives no rows; a text longer than a block
makes a longer block; columns beside ``text`` and ``lang`` are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from granary.session import discard, materialize

#: Words of a block.
BLOCK = 1 << 20
#: Parts of a language whose best rows are found apart.
TOP_PARTS = 16
#: Pieces end at these; the mark that stands for them is no part of UTF-8.
ENDS, MARK = b".,;:!?\n\v\f\r", b"\xff"
BYTES = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ" + ENDS, b"abcdefghijklmnopqrstuvwxyz" + MARK * len(ENDS))

#: Groups that one task counts at a time; beyond ``PARTS`` parts, up to four times as many.
PART, PARTS = 1 << 20, 1 << 10

RELATION = "block long, size int, at binary, grp binary, groups int"
#: An answer to a block (size, packed), or the part's frequent groups (the arrays).
ANSWERS = "block long, size int, packed binary, left array<{0}>, right array<{0}>, gid array<long>, f array<long>"


class Numbers(dict):
    """Numbers keys in the order in which they are met."""

    def __missing__(self, key):
        self[key] = n = len(self)
        return n


def word_relation(docs: DataFrame, block_words: int = BLOCK) -> DataFrame:
    """The occurrences of single words: a row per block, with the words that its groups stand for and their counts.

    A word is followed by a line end, which no word holds, and its language.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, seen = TaskContext.get().partitionId(), 0
        by_lang: dict[str, Numbers] = {}
        ids: list[np.ndarray] = []
        held = 0

        def block() -> pa.RecordBatch:
            nonlocal seen, ids, held
            # one numbering for all languages of the block; MARK is the first word of each
            langs = list(by_lang)
            start = dict(zip(langs, np.cumsum([0, *(len(by_lang[x]) for x in langs)]).tolist(), strict=False))
            grp = np.concatenate([a + start[x] for x, a in ids])
            words = [w for x in langs for w in by_lang[x]]
            at = np.flatnonzero(~np.isin(grp, list(start.values())))
            grp = grp[at]
            n = np.bincount(grp, minlength=len(words))
            real = np.argsort(-n, kind="stable")[: np.count_nonzero(n)]  # small numbers for frequent words pack well
            number = np.zeros(len(words), np.int32)
            number[real] = np.arange(len(real))
            lang_of = np.repeat(np.arange(len(langs)), [len(by_lang[x]) for x in langs])
            ends = [b"\n" + x.encode() for x in langs]
            keys = [words[i] + ends[k] for i, k in zip(real.tolist(), lang_of[real].tolist(), strict=True)]
            totals = np.bincount(lang_of, weights=n, minlength=len(langs)).astype(np.int64)
            sums = [{"lang": x, "n": k} for x, k in zip(langs, totals.tolist(), strict=True) if k]
            columns = [*_places(part << 41 | seen, at, number[grp]), pa.array([len(real)], pa.int32()), pa.array([_join(keys)], pa.binary())]
            columns += [pa.array([_pack(n[real])], pa.binary()), pa.array([sums], pa.list_(pa.struct({"lang": pa.string(), "n": pa.int64()})))]
            seen, held, ids = seen + held, 0, []
            by_lang.clear()
            return pa.RecordBatch.from_arrays(columns, names=["block", "size", "at", "grp", "groups", "words", "n", "langs"])

        for batch in batches:
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if not text:
                    continue
                numbers = by_lang.get(lang)
                if numbers is None:
                    numbers = by_lang[lang] = Numbers({MARK: 0})
                words = text.encode().translate(BYTES).replace(MARK, b" \xff ").split()
                words.append(MARK)
                ids.append((lang, np.fromiter(map(numbers.__getitem__, words), np.int32, len(words))))
                held += len(words)
                if held >= block_words:
                    yield block()
        if held:
            yield block()

    source = docs.select(F.coalesce("lang", F.lit("und")).alias("lang"), "text")
    return source.mapInArrow(run, f"{RELATION}, words binary, n binary, langs array<struct<lang string, n long>>")


def _places(block: int, at: np.ndarray, grp: np.ndarray) -> list[pa.Array]:
    # positions as steps: nearly all are 1 and take no room once packed
    packed = (_pack(x, kind=np.int32) for x in (np.diff(at, prepend=0), grp))
    return [pa.array([block], pa.int64()), pa.array([len(at)], pa.int32()), *(pa.array([x], pa.binary()) for x in packed)]


def _pack(*columns: np.ndarray, kind: type = np.int64) -> bytes:
    """Columns of numbers, byte by byte: the high bytes are alike and take no room."""
    wide = np.dtype(kind).itemsize
    planes = (np.ascontiguousarray(c, kind).view(np.uint8).reshape(-1, wide).T.tobytes() for c in columns)
    return pa.compress(b"".join(planes), "zstd", asbytes=True)


def _unpack(packed: bytes, size: int, columns: int, kind: type = np.int64) -> list[np.ndarray]:
    wide = np.dtype(kind).itemsize
    planes = np.frombuffer(pa.decompress(packed, wide * size * columns, "zstd", asbytes=True), np.uint8).reshape(columns, wide, size)
    return [np.ascontiguousarray(p.T).view(kind).ravel() for p in planes]


def _join(keys: list[bytes]) -> bytes:
    """UTF-8 strings in one, packed behind its length."""
    whole = MARK.join(keys)
    return len(whole).to_bytes(8) + pa.compress(whole, "zstd", asbytes=True)


def _split(packed: bytes) -> list[bytes]:
    return pa.decompress(packed[8:], int.from_bytes(packed[:8]), "zstd", asbytes=True).split(MARK)


def frequent_groups(relation: DataFrame, least: int) -> DataFrame:
    """block, local, left, right, gid, f: the groups of each block that the whole corpus holds ``least`` times or more."""
    each = relation.select("block", F.posexplode(F.arrays_zip("left", "right", "n")).alias("local", "g"))
    # plain columns, so that the exchange carries nothing twice
    plain = each.select("block", (F.col("block") + F.col("local")).alias("own"), F.col("g.left").alias("left"), F.col("g.right").alias("right"), F.col("g.n").alias("n"))
    alike = Window.partitionBy("left", "right")  # a row per block at most
    counted = plain.withColumn("f", F.sum("n").over(alike)).withColumn("gid", F.min("own").over(alike)).filter(F.col("f") >= least)
    return counted.select("block", (F.col("own") - F.col("block")).cast("int").alias("local"), "left", "right", "gid", "f")


def _part_size(total: int, part_groups: int) -> int:
    return min(max(part_groups, total // PARTS), 4 * part_groups)


def _dealt(part: np.ndarray, parts: int) -> Iterator[tuple[int, np.ndarray]]:
    """Each part that has groups, with their numbers in ascending order."""
    local = np.argsort(part, kind="stable")
    ends = np.cumsum(np.bincount(part, minlength=parts)).tolist()
    return ((p, local[a:b]) for p, (a, b) in enumerate(zip([0, *ends[:-1]], ends, strict=True)) if a < b)


def _bounds(relation: DataFrame, part_groups: int) -> tuple[np.ndarray, np.ndarray]:
    """The pairs at which all parts but the first begin, so that each part holds about as many groups of all blocks.

    They are quantiles of every ``step``-th pair of each block. No pair has more than a row per block, so no part is large
    for one pair's sake.
    """
    step = max(1, part_groups >> 6)

    def some(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block, size, packed in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                left, right, _ = _unpack(packed, size, 3)
                # blocks begin anywhere within a step, so that small ones have their share
                begin = (block * 0x9E3779B97F4A7C15 % (1 << 64) >> 32) % step
                yield pa.RecordBatch.from_arrays([pa.array(np.cumsum(left)[begin::step]), pa.array(right[begin::step])], names=["left", "right"])

    found = relation.select("block", "groups", "pairs").mapInArrow(some, "left long, right long").toArrow()
    left, right = (found.column(c).to_numpy() for c in ("left", "right"))
    order = np.lexsort((right, left))
    parts = max(1, -(-len(order) * step // _part_size(len(order) * step, part_groups)))
    cuts = order[np.arange(1, parts) * len(order) // parts]
    return left[cuts], right[cuts]


def _answers(block: np.ndarray, local: np.ndarray, n: np.ndarray, order: np.ndarray, first: np.ndarray, least: int):
    """Rows for the blocks of a part, and of each frequent group its place, name and count. ``order`` puts equal groups
    together, which begin at the places ``first`` of it."""
    block, local = block[order], local[order]
    alike = np.diff(first, append=len(order))  # one per block at most
    f, gid = np.add.reduceat(n[order], first), np.minimum.reduceat(block + local, first)
    kept = f >= least
    stay = np.repeat(kept, alike)
    block, local, name = block[stay], local[stay], np.repeat(gid[kept], alike[kept])
    by = np.lexsort((local, block))
    block, local, name = block[by], local[by], name[by]
    ends = [0, *(np.flatnonzero(block[1:] != block[:-1]) + 1).tolist(), len(block)]
    rows = [(int(block[a]), b - a, _pack(np.diff(local[a:b], prepend=0), name[a:b])) for a, b in zip(ends, ends[1:], strict=False) if a < b]
    return rows, order[first[kept]], gid[kept], f[kept]


def _answer_table(rows: list[tuple], left: pa.Array, right: pa.Array, gid: np.ndarray, f: np.ndarray) -> pa.Table:
    kinds = {"block": pa.int64(), "size": pa.int32(), "packed": pa.binary()}
    columns = {name: pa.array([*(r[k] for r in rows), None], kind) for k, (name, kind) in enumerate(kinds.items())}
    for name, values in {"left": left, "right": right, "gid": pa.array(gid, pa.int64()), "f": pa.array(f, pa.int64())}.items():
        # none for the blocks, then all of the part
        columns[name] = pa.ListArray.from_arrays(pa.array([None] * len(rows) + [0, len(values)], pa.int32()), values)
    return pa.table(columns)


def packed_words(relation: DataFrame, least: int, part_groups: int = PART) -> DataFrame:
    """The groups of ``word_relation`` that the whole corpus holds ``least`` times or more, as ``ANSWERS``.

    There are as many parts as hold ``part_groups`` groups each, whatever the corpus.
    """
    total = relation.agg(F.sum("groups").alias("n")).first()["n"] or 0
    parts = max(1, -(-total // _part_size(total, part_groups)))

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block, size, words, n in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if not size:  # marks only
                    continue
                keys, (n,) = _split(words), _unpack(n, size, 1)
                part = np.fromiter(map(crc32, keys), np.int64, size) % parts
                rows = [(p, block, len(mine), _pack(np.diff(mine, prepend=0), n[mine]), _join([keys[k] for k in mine.tolist()])) for p, mine in _dealt(part, parts)]
                kinds = (pa.int32(), pa.int64(), pa.int32(), pa.binary(), pa.binary())
                yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*rows, strict=True), kinds, strict=True)], names=["part", "block", "size", "packed", "words"])

    def count(part: pa.Table) -> pa.Table:
        size = part.column("size").to_numpy()
        steps, n = zip(*(_unpack(x, k, 2) for x, k in zip(part.column("packed").to_pylist(), size.tolist(), strict=True)), strict=True)
        local = np.concatenate([np.cumsum(x) for x in steps])
        block = np.repeat(part.column("block").to_numpy(), size)
        words = pa.chunked_array([pa.array(_split(x), pa.binary()) for x in part.column("words").to_pylist()]).combine_chunks().dictionary_encode()
        number = words.indices.to_numpy()
        order = np.argsort(number, kind="stable")
        first = np.flatnonzero(np.diff(number[order], prepend=-1))
        rows, place, gid, f = _answers(block, local, np.concatenate(n), order, first, least)
        keys = [x.split(b"\n", 1) for x in words.dictionary.take(pa.array(number[place])).to_pylist()]
        right, left = (pa.array([x[k] for x in keys], pa.binary()).cast(pa.string()) for k in (0, 1))
        return _answer_table(rows, left, right, gid, f)

    dealt = relation.select("block", "groups", "words", "n").mapInArrow(deal, "part int, block long, size int, packed binary, words binary")
    return dealt.groupBy("part").applyInArrow(count, ANSWERS.format("string"))


def packed_pairs(relation: DataFrame, least: int, part_groups: int = PART) -> DataFrame:
    """``packed_words`` for ``longer_relation``, whose groups are known by two numbers.

    A block's groups are sorted by these, and a part is a range of them, so that neighbours travel together as small steps.
    """
    lefts, rights = _bounds(relation, part_groups)

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block, size, packed in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                left, right, n = _unpack(packed, size, 3)
                left = np.cumsum(left)
                low, high = np.searchsorted(left, lefts, "left"), np.searchsorted(left, lefts, "right")
                ends = [0, *(a + int(np.searchsorted(right[a:b], r)) for a, b, r in zip(low.tolist(), high.tolist(), rights.tolist(), strict=True)), size]
                rows = [(p, block, b - a, a, _pack(np.diff(left[a:b], prepend=0), right[a:b], n[a:b])) for p, (a, b) in enumerate(zip(ends, ends[1:], strict=False)) if a < b]
                if not rows:
                    continue
                kinds = (pa.int32(), pa.int64(), pa.int32(), pa.int32(), pa.binary())
                yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*rows, strict=True), kinds, strict=True)], names=["part", "block", "size", "begin", "packed"])

    def count(part: pa.Table) -> pa.Table:
        size = part.column("size").to_numpy()
        columns = zip(*(_unpack(x, n, 3) for x, n in zip(part.column("packed").to_pylist(), size.tolist(), strict=True)), strict=True)
        left, right, n = map(list, columns)
        local = np.concatenate([np.arange(a, a + k) for a, k in zip(part.column("begin").to_pylist(), size.tolist(), strict=True)])
        left, right, n = np.concatenate([np.cumsum(x) for x in left]), np.concatenate(right), np.concatenate(n)
        block = np.repeat(part.column("block").to_numpy(), size)
        order = np.lexsort((right, left))
        x, y = left[order], right[order]
        first = np.flatnonzero(np.concatenate([[True], (x[1:] != x[:-1]) | (y[1:] != y[:-1])]))
        rows, place, gid, f = _answers(block, local, n, order, first, least)
        return _answer_table(rows, pa.array(left[place]), pa.array(right[place]), gid, f)

    dealt = relation.select("block", "groups", "pairs").mapInArrow(deal, "part int, block long, size int, begin int, packed binary")
    return dealt.groupBy("part").applyInArrow(count, ANSWERS.format("long"))


def frequent_pairs(relation: DataFrame, least: int, part_groups: int = PART) -> DataFrame:
    """``packed_pairs`` with a row per block and group, as ``frequent_groups`` has them."""
    groups = packed_pairs(relation, least, part_groups)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block, size, packed in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                steps, gid = _unpack(packed, size, 2)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(size, block)), pa.array(np.cumsum(steps).astype(np.int32)), pa.array(gid)], names=["block", "local", "gid"])

    known = groups.filter("block is not null").select("block", "size", "packed").mapInArrow(rows, "block long, local int, gid long")
    return known.join(named(groups), "gid").select("block", "local", "left", "right", "gid", "f")


def longer_relation(relation: DataFrame, groups: DataFrame) -> DataFrame:
    """Merge join of the frequent occurrences on adjacent positions: the occurrences of phrases one word longer."""
    answers = groups.filter("block is not null").select("block", "size", "packed")
    known = answers.groupBy("block").agg(F.collect_list(F.struct("size", "packed")).alias("known"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                block, size = (batch.column(c)[k].as_py() for c in (0, 1))
                sizes, packed = (x.to_pylist() for x in batch.column(4)[k].values.flatten())
                steps, gid = zip(*(_unpack(x, n, 2) for x, n in zip(packed, sizes, strict=True)), strict=True)
                local, gid = np.concatenate([np.cumsum(x) for x in steps]), np.concatenate(gid)
                by = np.argsort(gid)  # sorted numbers pack well
                local, gid = local[by], gid[by]
                at, grp = (_unpack(batch.column(c)[k].as_py(), size, 1, np.int32)[0] for c in (2, 3))
                at = np.cumsum(at, dtype=np.int32)
                # semi-join: occurrences of frequent groups stay, numbered by their place among these
                place = np.full(max(int(grp.max(initial=-1)), int(local.max())) + 1, -1, np.int32)
                place[local] = np.arange(len(local), dtype=np.int32)
                grp = place[grp]
                at, grp = at[grp >= 0], grp[grp >= 0]
                # merge join on the next position of the piece
                meet = np.flatnonzero(at[1:] == at[:-1] + 1)
                if not len(meet):
                    continue
                both, number, n = np.unique(grp[meet].astype(np.int64) * len(local) + grp[meet + 1], return_inverse=True, return_counts=True)
                left, right = np.divmod(both, len(local))
                # a group's number is its place in these lists
                left, right = gid[left], gid[right]
                columns = [*_places(block, at[meet], number), pa.array([len(n)], pa.int32()), pa.array([_pack(np.diff(left, prepend=0), right, n)], pa.binary())]
                yield pa.RecordBatch.from_arrays(columns, names=["block", "size", "at", "grp", "groups", "pairs"])

    source = relation.select("block", "size", "at", "grp").join(known, "block")
    return source.mapInArrow(run, f"{RELATION}, pairs binary")


def named(groups: DataFrame) -> DataFrame:
    """One row per group: left, right, gid, f."""
    each = groups.filter("block is null").select(F.explode(F.arrays_zip("left", "right", "gid", "f")).alias("g"))
    return each.select("g.left", "g.right", "g.gid", "g.f")


def count_words(relation: DataFrame) -> DataFrame:
    """lang and its number of words (total)."""
    each = relation.select(F.explode("langs").alias("g"))
    return each.groupBy("g.lang").agg(F.sum("g.n").alias("total"))


def mine(docs: DataFrame, least: int = 100, longest: int = 5, block_words: int = BLOCK) -> DataFrame:
    """Candidates of 2 to ``longest`` words that no longer candidate takes up: lang, phrase, a, l, r, n, score."""
    relation = materialize(word_relation(docs, block_words), "words")
    totals = materialize(count_words(relation), "totals")
    groups = materialize(packed_words(relation, least), "groups")
    # counts of a phrase's beginnings and ends, shortest first
    one = named(groups).select("gid", "f", F.col("left").alias("lang"), F.array("right").alias("words"), F.array("f").alias("fronts"), F.array("f").alias("backs"))
    shorter = materialize(one, "phrases")
    found: list[DataFrame] = []
    for length in range(2, longest + 1):
        longer = materialize(longer_relation(relation, groups), "relation")
        discard(relation, groups)
        relation, groups = longer, materialize(packed_pairs(longer, least), "groups")
        a = shorter.select(F.col("gid").alias("left"), "lang", F.col("words").alias("begin"), "fronts")
        b = shorter.select(F.col("gid").alias("right"), F.element_at("words", -1).alias("last"), "backs")
        joined = named(groups).join(a, "left").join(b, "right")
        now = joined.select(
            "gid", "f", "left", "right", "lang",
            F.concat("begin", F.array("last")).alias("words"),
            F.concat("fronts", F.array("f")).alias("fronts"),
            F.concat("backs", F.array("f")).alias("backs"),
        )
        shorter = materialize(now, "phrases")
        if length > 2:
            found[-1] = found[-1].join(_taken_up(shorter, length - 1), "gid", "left_anti")
        found.append(shorter)
    discard(relation, groups)
    rest = found[0]
    for more in found[1:]:
        rest = rest.unionByName(more)
    return _scores(rest, totals)


def _taken_up(longer: DataFrame, length: int) -> DataFrame:
    """Groups of ``length`` words that stand inside a longer candidate whenever they stand anywhere.

    One word more is enough to look at: what lies between a phrase and a longer one that is as frequent is as frequent.
    """
    before = longer.filter(F.col("f") >= F.element_at("fronts", length)).select(F.col("left").alias("gid"))
    behind = longer.filter(F.col("f") >= F.element_at("backs", length)).select(F.col("right").alias("gid"))
    return before.union(behind).distinct()


def _scores(phrases: DataFrame, totals: DataFrame) -> DataFrame:
    """The lowest-scoring cut of each phrase, in whole numbers: 16 digits times 16 times 1,000 fit the 38 of a decimal."""

    def wide(column):
        return column.cast("decimal(16,0)")

    cuts = F.transform(F.sequence(F.lit(1), F.size("words") - 1), lambda k: F.struct(k.alias("k"), F.element_at("fronts", k).alias("l"), F.element_at("backs", F.size("words") - k).alias("r")))
    each = phrases.join(totals, "lang").withColumn("cuts", cuts).withColumn("top", F.lit(1000).cast("decimal(4,0)") * (wide(F.col("f")) * wide(F.col("total"))))
    score = "cast(top div (cast(c.l as decimal(16,0)) * cast(c.r as decimal(16,0))) as bigint)"
    # the least of these structs has the lowest score, then the shortest first part
    least = F.expr(f"array_min(transform(cuts, c -> named_struct('score', {score}, 'k', c.k, 'l', c.l, 'r', c.r)))")
    scored = each.withColumn("least", least)
    return scored.select("lang", F.array_join("words", " ").alias("phrase"), F.col("f").alias("a"), "least.l", "least.r", F.col("total").alias("n"), "least.score")


def best(candidates: DataFrame, top: int = 2000) -> DataFrame:
    """The first ``top`` of each language, with their rank from 1."""
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    part = F.pmod(F.xxhash64("phrase"), F.lit(TOP_PARTS))
    few = candidates.withColumn("place", F.row_number().over(Window.partitionBy("lang", part).orderBy(*order))).filter(F.col("place") <= top)
    ranked = few.withColumn("place", F.row_number().over(Window.partitionBy("lang").orderBy(*order))).filter(F.col("place") <= top)
    return ranked.select("lang", F.col("place").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
