"""Words and hashes of whole batches of texts as arrays, for the Python stages."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa

BASE = np.uint64(0x9E3779B97F4A7C15)
#: Python's inverse of BASE modulo 2**64.
BASE_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))


def word_table(keep: bytes = b"", high: bool = True) -> np.ndarray:
    """256 byte values: 0 for separators, else the byte with A-Z lower-cased. ``keep`` are the ASCII word bytes."""
    table = np.zeros(256, np.uint8)
    for b in keep:
        table[b] = b | 32 if 65 <= b <= 90 else b
    if high:
        table[128:] = np.arange(128, 256)
    return table


#: Words of letters, digits and everything beyond ASCII; words between white space.
ALNUM = word_table(bytes(b for b in range(128) if chr(b).isalnum()))
NONSPACE = word_table(bytes(b for b in range(128) if b not in b" \t\n\v\f\r"))
NONSPACE[0] = 255  # a word byte; 255 never stands in UTF-8


def mix(x: np.ndarray) -> np.ndarray:
    """Finalizer of a 64-bit hash."""
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def byte_values() -> np.ndarray:
    return mix(np.arange(1, 257, dtype=np.uint64) * BASE)


def powers(base: np.uint64, n: int) -> np.ndarray:
    out = np.full(n + 1, base, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


def prefix_hash(data: np.ndarray) -> np.ndarray:
    """Running polynomial hash modulo 2**64; a slice's hash is the difference of two values times a power of BASE_INVERSE."""
    out = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(byte_values()[data] * powers(BASE, len(data))[:-1], out=out[1:])
    return out


def slice_hash(prefix: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    inverse = powers(BASE_INVERSE, int(start.max()) if len(start) else 0)
    return mix((prefix[end] - prefix[start]) * inverse[start] + (end - start).astype(np.uint64))


def joined(texts: Iterable[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of all texts, each followed by a line break, and where each starts (one entry more than texts)."""
    encoded = [(t or "").encode() for t in texts]
    starts = np.zeros(len(encoded) + 1, np.int64)
    np.cumsum([len(e) + 1 for e in encoded], out=starts[1:])
    return np.frombuffer(b"\n".join(encoded) + b"\n" * bool(encoded), np.uint8), starts


class Words:
    """The words of a batch of texts: byte ranges, text numbers and hashes."""

    def __init__(self, texts: Iterable[str | None], table: np.ndarray):
        raw, self.starts = joined(texts)
        self.data = table[raw]
        edge = np.diff(np.concatenate(([0], (self.data != 0).view(np.int8), [0])))
        self.start, self.end = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
        self.doc = np.searchsorted(self.starts, self.start, side="right") - 1
        self.hash = slice_hash(prefix_hash(self.data), self.start, self.end)
        #: first word of each text, one entry more than texts
        self.first = np.searchsorted(self.doc, np.arange(len(self.starts)))

    def grams(self, k: int) -> tuple[np.ndarray, np.ndarray]:
        """A hash for each run of k words, and whether the run lies in one text."""
        n = max(0, len(self.hash) - k + 1)
        out = np.zeros(n, np.uint64)
        for j in range(k):
            out = out * BASE + self.hash[j : j + n]
        return mix(out + np.uint64(k)), self.doc[:n] == self.doc[k - 1 : k - 1 + n]

    def words(self, lo: int, hi: int) -> str:
        """Words lo..hi of the batch, lower-cased, with a space between."""
        return b" ".join(self.data[a:b].tobytes() for a, b in zip(self.start[lo:hi], self.end[lo:hi], strict=True)).decode()


def slabs(batch: pa.RecordBatch, column: str, size: int = 1 << 21) -> Iterator[tuple[int, list[str | None]]]:
    """Runs of a text column of about ``size`` characters, with the number of their first row; a longer text is alone."""
    texts = batch.column(batch.schema.get_field_index(column)).to_pylist()
    at, held = 0, 0
    for i, t in enumerate(texts):
        if held and held + len(t or "") > size:
            yield at, texts[at:i]
            at, held = i, 0
        held += len(t or "")
    if at < len(texts):
        yield at, texts[at:]
