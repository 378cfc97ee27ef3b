"""Byte-level BPE by replaying the merges over a corpus of words.

A text is cut into words by the vocabulary's pattern, and a word's ids depend on the word alone. So each task gathers the
distinct words of the texts it reads, slab by slab, and replays the merge list over all new ones together: an inverted index
leads from each pair of neighbouring tokens (known by the rank of the bytes they make) to the places where it stands; the
lowest rank is taken first, its places from left to right, and only the pairs beside a merge are looked up again. Words
met before keep their ids in a table of bounded size, so a common word is merged once per task.

The order within a word is that of plain BPE: always the lowest rank, the leftmost place among equals. If a merge makes a
pair of a lower rank than the one in hand, what is left of that word waits until the lower rank is done. A word that is
itself an entry of the vocabulary is that entry.

Tasks share nothing, nothing is shuffled and no row waits for another task: a hot source or a group of copies is as cheap
as any other rows, and a lost task is read again.

Defined cases: a null or empty text has no ids (an empty list) and decodes to no bytes; every row is kept, repeated rows and
ids as often as they come; an empty table gives no rows; a text without any white space is one long word and is merged
whole; strings of special tokens are ordinary text; columns beside ``doc_id`` and ``text`` are ignored.
"""

from __future__ import annotations

import base64
import heapq
from array import array
from bisect import bisect_left, bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from granary.llm.text import slabs

#: Code points that newer Unicode tables count as letters or numbers, and the encoder's own tables do not yet.
UNKNOWN = """
558 58B-58C 88F C5C CDC 208F 209D-209F A7CE-A7CF A7D2 A7D4 A7DD A7E2 A7F1 AB6C-AB6D 107BB-107BF 10940-10959 10EC5-10EC7
10ED9-10EEE 11B0A 11DB0-11DDB 11DE0-11DE9 11DF1 1246F 12475-1247F 12550-12686 16EA0-16EB8 16EBB-16ED3 16FF2-16FF6
187F8-187FF 18CD6-18CDA 18D09-18D20 18D80-18DF2 18E00-19191 191A0-191D2 1B123-1B128 1B168 1D6A6 1DF1F-1DF24 1DF2B-1DF81
1DF90-1DF96 1DFCD-1DFFF 1E6C0-1E6DE 1E6E0-1E6E2 1E6E4-1E6E5 1E6E7-1E6ED 1E6F0-1E6F4 1E6FE-1E6FF 2B73A-2B73F 2B81E
2CEA2-2CEAD 323B0-33479 3D000-3FC3F
"""

#: Words (and their bytes) whose ids a task keeps; a fuller table is begun anew.
TABLE_WORDS, TABLE_BYTES = 1 << 20, 1 << 25


def read_ranks(ranks_file: str) -> dict[bytes, int]:
    """Token bytes to rank, from a file of base64 and rank lines."""
    with open(ranks_file, "rb") as f:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, f)}


def cutter(pattern: str):
    """Cuts a text at the matches of ``pattern``; unknown letters and numbers count as marks that are neither."""
    import regex

    match = regex.compile(pattern)
    unknown = regex.compile("[" + "".join("-".join(chr(int(c, 16)) for c in run.split("-")) for run in UNKNOWN.split()) + "]")

    def cut(text: str | None) -> list[str]:
        if not text:
            return []
        if text.isascii() or not unknown.search(text):
            return match.findall(text)
        return [text[slice(*m.span())] for m in match.finditer(unknown.sub("\ue000", text))]

    return cut


class Replay:
    """Merges over many words at once."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.width = {rank: len(token) for token, rank in ranks.items()}
        self.single = np.array([ranks[bytes([b])] for b in range(256)], np.int32)
        self.couple = np.full(1 << 16, -1, np.int64)
        for token, rank in ranks.items():
            if len(token) == 2:
                self.couple[token[0] << 8 | token[1]] = rank

    def ids(self, words: list[bytes]) -> list[np.ndarray]:
        """The ids of each word; no word is empty."""
        out: list[np.ndarray | None] = [None] * len(words)
        open_words = []
        for k, w in enumerate(words):
            rank = self.ranks.get(w)
            if rank is None:
                open_words.append(k)
            else:
                out[k] = np.array([rank], np.int32)
        if open_words:
            for k, ids in zip(open_words, self._merge([words[k] for k in open_words]), strict=True):
                out[k] = ids
        return out

    def _merge(self, words: list[bytes]) -> list[np.ndarray]:
        data = b"".join(words)
        n = len(data)
        raw = np.frombuffer(data, np.uint8)
        bounds = np.zeros(len(words) + 1, np.int64)
        np.cumsum([len(w) for w in words], out=bounds[1:])
        edges = bounds.tolist()
        edge = bytearray(n + 1)  # 1 where a word begins, and at the end
        np.frombuffer(edge, np.uint8)[bounds] = 1

        token = array("i", self.single[raw].tobytes())
        size = array("i", np.ones(n, np.int32).tobytes())  # bytes of the token that begins here, 0 inside a token
        before = array("i", np.arange(-1, n - 1, dtype=np.int32).tobytes())  # where the token to the left begins

        # the inverted index: rank of a pair to the places of its left token
        rank = self.couple[raw[:-1].astype(np.int64) << 8 | raw[1:]] if n > 1 else np.zeros(0, np.int64)
        rank[bounds[1:-1] - 1] = -1
        places = np.flatnonzero(rank >= 0)
        places = places[np.argsort(rank[places], kind="stable")]
        found, first = np.unique(rank[places], return_index=True)
        index = {r: array("i", p.astype(np.int32).tobytes()) for r, p in zip(found.tolist(), np.split(places, first[1:]), strict=True)} if len(found) else {}
        queue = found.tolist()

        ranks, width = self.ranks, self.width
        while queue:
            r = heapq.heappop(queue)
            here, length, waits, q = index.pop(r), width[r], array("i"), 0
            if any(a > b for a, b in zip(here, here[1:], strict=False)):
                here = array("i", sorted(here))
            while q < len(here):
                i = here[q]
                q += 1
                if not size[i]:
                    continue
                j = i + size[i]
                if j >= i + length or j + size[j] != i + length:
                    continue  # a neighbour has been merged meanwhile
                size[i], size[j], token[i] = length, 0, r
                k = i + length
                lower = False
                if not edge[k]:
                    before[k] = i
                    s = ranks.get(data[i : k + size[k]])
                    if s is not None:
                        lower = s < r
                        if s in index:
                            index[s].append(i)
                        else:
                            index[s] = array("i", (i,))
                            heapq.heappush(queue, s)
                if not edge[i]:
                    p = before[i]
                    s = ranks.get(data[p:k])
                    if s is not None:
                        lower = lower or s < r
                        if s in index:
                            index[s].append(p)
                        else:
                            index[s] = array("i", (p,))
                            heapq.heappush(queue, s)
                if lower:
                    end = bisect_left(here, edges[bisect_right(edges, i)], q)
                    waits.extend(here[q:end])
                    q = end
            if waits:
                index[r] = waits
                heapq.heappush(queue, r)

        alive = np.flatnonzero(np.frombuffer(size, np.int32))
        return np.split(np.frombuffer(token, np.int32)[alive], np.searchsorted(alive, bounds[1:-1]))


class Table(dict):
    """Number of each word met, in order; the ids of all words end to end."""

    def __init__(self):
        super().__init__()
        self.fresh: list[str] = []
        self.flat, self.first, self.bytes = np.zeros(0, np.int32), np.zeros(1, np.int64), 0

    def __missing__(self, word: str) -> int:
        self[word] = at = len(self)
        self.fresh.append(word)
        return at

    def learn(self, replay: Replay) -> None:
        if self.fresh:
            words = [w.encode() for w in self.fresh]
            ids = replay.ids(words)
            self.bytes += sum(map(len, words))
            self.fresh = []
            self.flat = np.concatenate([self.flat, *ids])
            self.first = np.concatenate([self.first, self.first[-1] + np.cumsum([len(x) for x in ids])])


def gather(flat: np.ndarray, first: np.ndarray, which: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The entries ``which`` of a table of runs end to end, and where each begins in the result (one number more)."""
    length = first[which + 1] - first[which]
    at = np.zeros(len(which) + 1, np.int64)
    np.cumsum(length, out=at[1:])
    return flat[np.repeat(first[which] - at[:-1], length) + np.arange(at[-1])], at


def encode(docs: DataFrame, ranks_file: str, pattern: str) -> DataFrame:
    """doc_id and ids (array of int) of every row's whole text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cut, replay, table = cutter(pattern), Replay(read_ranks(ranks_file)), Table()
        for batch in batches:
            ids = batch.column(batch.schema.get_field_index("doc_id"))
            for at, texts in slabs(batch, "text"):
                if len(table) > TABLE_WORDS or table.bytes > TABLE_BYTES:
                    table = Table()
                which = [np.fromiter(map(table.__getitem__, w), np.int64, len(w)) for w in map(cut, texts)]
                table.learn(replay)
                flat, begin = gather(table.flat, table.first, np.concatenate(which))
                ends = np.cumsum([0, *map(len, which)])
                lists = pa.ListArray.from_arrays(pa.array(begin[ends], pa.int32()), pa.array(flat, pa.int32()))
                yield pa.RecordBatch.from_arrays([ids.slice(at, len(texts)), lists], names=["doc_id", "ids"])

    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, ids array<int>")


def decode(encoded: DataFrame, ranks_file: str) -> DataFrame:
    """doc_id, ids and the bytes that the ids stand for, as ``decoded``; null ids are none."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = {rank: token for token, rank in read_ranks(ranks_file).items()}
        first = np.zeros(max(tokens) + 2, np.int64)
        np.cumsum([len(tokens.get(r, b"")) for r in range(len(first) - 1)], out=first[1:])
        flat = np.frombuffer(b"".join(tokens[r] for r in sorted(tokens)), np.uint8)
        for batch in batches:
            lists = batch.column(1)
            data, out = lists.values.to_numpy(zero_copy_only=False), []
            for a, b in zip(lists.offsets.to_pylist(), lists.offsets.to_pylist()[1:], strict=False):
                out.append(gather(flat, first, data[a:b])[0].tobytes())
            yield pa.RecordBatch.from_arrays([batch.column(0), lists, pa.array(out, pa.binary())], names=["doc_id", "ids", "decoded"])

    return encoded.select("doc_id", "ids").mapInArrow(run, f"doc_id {encoded.schema['doc_id'].dataType.simpleString()}, ids array<int>, decoded binary")
