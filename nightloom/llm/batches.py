"""Distinct texts packed into content-addressed batches, and questions that batches ask of hashed key ranges.

Corpus statistics on word sequences need a key per word. As rows of their own, keys would cost several times the
corpus in shuffles. Here each batch of some megabytes of text sends, per key range, one binary column with its
different keys (so a key that a third of all texts holds arrives once per batch, not once per text); the range
answers each batch. Spark does the grouping, shuffling and spilling; numpy works within a batch or a range. Batches
are sorted by digest, so a recomputed task gives the same bytes whatever order its rows arrive in.
"""

from __future__ import annotations

import hashlib
import struct
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import give_back

BATCH_CHARS = 8 << 20
RANGE_CHARS = 16 << 20
FLUSH_CHARS = 12 << 20
U64 = np.uint64


def digest_of(text: Column) -> Column:
    """A 128-bit digest of a text; null for null."""
    return F.unhex(F.substring(F.sha2(text, 256), 1, 32))


def total_chars(docs: DataFrame, text: str) -> int:
    return docs.agg(F.coalesce(F.sum(F.char_length(text)), F.lit(0)).alias("n")).first()["n"]


def packed_texts(docs: DataFrame, text: str, n_batches: int, weight: Column | None = None) -> DataFrame:
    """(batch, blob): the distinct non-null texts, each with its number of rows and the sum of ``weight`` over them.

    A task sends a text once, however many copies it reads. Texts of a batch share a compressed column.
    """
    rows = docs.filter(F.col(text).isNotNull()).select(F.col(text).alias("t"), (F.lit(1) if weight is None else weight).cast("int").alias("w"))

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import zstandard

        # copies that come after their text has gone out follow as bare counts
        sent: set[bytes] = set()
        held: dict[bytes, list] = {}
        size = 0

        def flush() -> pd.DataFrame:
            by_batch: dict[int, list[bytes]] = {}
            for d, (raw, n, w) in held.items():
                known = raw is None
                body = b"" if known else raw
                by_batch.setdefault(int.from_bytes(d[:8], "little") % n_batches, []).append(struct.pack("<16sqq?I", d, n, w, known, len(body)) + body)
            pack = zstandard.ZstdCompressor(level=3).compress
            return pd.DataFrame({"batch": np.array(list(by_batch), np.int64), "blob": [pack(b"".join(x)) for x in by_batch.values()]})

        for part in parts:
            for t, w in zip(part["t"], part["w"], strict=True):
                raw = t.encode("utf-8", "surrogatepass")
                d = hashlib.sha256(raw).digest()[:16]
                if d in held:
                    held[d][1] += 1
                    held[d][2] += int(w)
                    continue
                new = d not in sent
                held[d] = [raw if new else None, 1, int(w)]
                sent.add(d)
                size += len(raw) if new else 40
                if size > FLUSH_CHARS:
                    yield flush()
                    held.clear()
                    size = 0
        if held:
            yield flush()
        held.clear()
        sent.clear()
        give_back()

    return rows.mapInPandas(run, "batch bigint, blob binary")


def tidied(fn: Callable) -> Callable:
    """A grouped map over one table that gives its memory back after each group."""

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        out = fn(pdf)
        powers.cache_clear()
        give_back()
        return out

    return run


def tidied_pair(fn: Callable) -> Callable:
    """The same over two tables."""

    def run(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        out = fn(left, right)
        powers.cache_clear()
        give_back()
        return out

    return run


class Texts:
    """A batch unpacked: digests in order, texts as UTF-8, numbers of rows and weights."""

    def __init__(self, blobs: list[bytes]):
        import zstandard

        raw: dict[bytes, bytes] = {}
        n: dict[bytes, int] = {}
        w: dict[bytes, int] = {}
        head = struct.calcsize("<16sqq?I")
        for blob in blobs:
            data, at = zstandard.ZstdDecompressor().decompress(blob), 0
            while at < len(data):
                d, rows, weight, known, size = struct.unpack_from("<16sqq?I", data, at)
                at += head
                if not known:
                    raw[d] = data[at : at + size]
                at += size
                n[d] = n.get(d, 0) + rows
                w[d] = w.get(d, 0) + weight
        self.digests = sorted(raw)
        self.texts = [raw[d] for d in self.digests]
        self.rows = np.array([n[d] for d in self.digests], np.int64)
        self.weights = np.array([w[d] for d in self.digests], np.int64)


@lru_cache(4)
def powers(base: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """base**i and base**-i modulo 2**64."""
    with np.errstate(over="ignore"):
        up, down = np.full(n, base, U64), np.full(n, pow(base, -1, 1 << 64), U64)
        up[0] = down[0] = 1
        return np.cumprod(up, dtype=U64), np.cumprod(down, dtype=U64)


def mixed(x: np.ndarray) -> np.ndarray:
    """Splitmix64's last steps (a public bit mixer)."""
    with np.errstate(over="ignore"):
        x = (x ^ x >> U64(30)) * U64(0xBF58476D1CE4E5B9)
        x = (x ^ x >> U64(27)) * U64(0x94D049BB133111EB)
        return x ^ x >> U64(31)


BYTE_BASE, SECOND_BYTE_BASE, WORD_BASE, SECOND_BASE = 0x5851F42D4C957F2D, 0xDA942042E4DD58B5, 0x2545F4914F6CDD1D, 0x9E6C63D0876A9A47
SLICE = 1 << 18


def lowered(data: bytes) -> bytes:
    """A-Z in lower case, other bytes as they are."""
    return data.translate(LOWER)


LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))


class Words:
    """The words (between ASCII white space) of a batch: 64-bit hashes, byte places, and where each text's begin.

    With ``twice`` each word has a second hash, of other powers and another mix, so that two words taken for one would have to agree in 128 bits.
    """

    def __init__(self, texts: list[bytes], lower: bool = False, twice: bool = False):
        data = b"\n".join(texts) + b"\n" if texts else b"\n"
        if lower:
            data = lowered(data)
        self.data = data
        b = np.frombuffer(data, np.uint8)
        space = (b == 32) | ((b >= 9) & (b <= 13))
        edge = np.flatnonzero(space[1:] != space[:-1]) + 1
        if not space[0]:
            edge = np.concatenate([[0], edge])
        self.start, self.end = edge[0::2], edge[1::2]
        self.hash = np.empty(len(self.start), U64)
        self.hash2 = np.empty(len(self.start), U64) if twice else None
        at = 0
        with np.errstate(over="ignore"):
            while at < len(self.start):  # slices end between words
                stop = max(at + 1, int(np.searchsorted(self.end, self.start[at] + SLICE, "right")))
                lo, hi = int(self.start[at]), int(self.end[stop - 1])
                n = 1 << max(18, (hi - lo + 1).bit_length())
                up, down = powers(BYTE_BASE, n)
                total = np.zeros(hi - lo + 1, U64)
                np.cumsum((b[lo:hi].astype(U64) + U64(1)) * up[: hi - lo], out=total[1:])
                s, e = self.start[at:stop] - lo, self.end[at:stop] - lo
                self.hash[at:stop] = mixed((total[e] - total[s]) * down[s] + (e - s).astype(U64) * U64(0x632BE59BD9B4E019))
                if twice:
                    up, down = powers(SECOND_BYTE_BASE, n)
                    np.cumsum(mixed(b[lo:hi].astype(U64) + U64(1)) * up[: hi - lo], out=total[1:])
                    self.hash2[at:stop] = mixed((total[e] - total[s]) * down[s] + (e - s).astype(U64) * U64(0x9FB21C651E98DF25))
                at = stop
        sizes = np.array([len(t) + 1 for t in texts], np.int64)
        self.first = np.searchsorted(self.start, np.concatenate([[0], np.cumsum(sizes)]))  # of each text, and the end
        self.count = np.diff(self.first)
        self.place = np.arange(len(self.start)) - np.repeat(self.first[:-1], self.count)  # within its text
        self.left = np.repeat(self.count, self.count) - self.place  # words from here to the text's end

    def sequences(self, length: int, base: int, second: bool = False) -> np.ndarray:
        """A hash of the ``length`` words from each word on (of their second hashes); those that reach over a text's end mean nothing."""
        n = len(self.hash)
        with np.errstate(over="ignore"):
            up, down = powers(base, 1 << max(18, (n + 1).bit_length()))
            total = np.zeros(n + 1, U64)
            np.cumsum((self.hash2 if second else self.hash) * up[:n], out=total[1:])
            out = np.zeros(n, U64)
            if n >= length:
                out[: n - length + 1] = mixed((total[length:] - total[:-length]) * down[: n - length + 1])
        return out


def ranges_of(keys: np.ndarray, n_ranges: int) -> np.ndarray:
    """The range of each key, from its high bits, so that sorted keys are sorted by range too."""
    return ((keys >> U64(32)) * U64(n_ranges) >> U64(32)).astype(np.int64)


def split_by_range(keys: np.ndarray, n_ranges: int) -> list[tuple[int, int, int]]:
    """(range, from, to) over keys that are sorted."""
    r = ranges_of(keys, n_ranges)
    ids = np.unique(r)
    return [(int(i), int(a), int(z)) for i, a, z in zip(ids, np.searchsorted(r, ids, "left"), np.searchsorted(r, ids, "right"), strict=True)]


def packed_keys(keys: np.ndarray) -> bytes:
    """Sorted keys as compressed planes of their differences' bytes."""
    import zstandard

    return zstandard.ZstdCompressor(level=1).compress(np.diff(keys, prepend=U64(0)).view(np.uint8).reshape(-1, 8).T.tobytes())


def unpacked_keys(data: bytes) -> np.ndarray:
    import zstandard

    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8).reshape(8, -1)
    return np.cumsum(np.ascontiguousarray(planes.T).view(U64).ravel(), dtype=U64)


def packed_values(values: np.ndarray) -> bytes:
    """Numbers compressed, whole ones of 0 or more in as few bytes as the largest needs."""
    import zstandard

    if values.dtype == np.int64:
        values = values.astype(np.min_scalar_type(int(values.max()) if len(values) else 0))
    return zstandard.ZstdCompressor(level=1).compress(values.dtype.char.encode() + values.tobytes())


def unpacked_values(data: bytes, kind: type) -> np.ndarray:
    import zstandard

    raw = zstandard.ZstdDecompressor().decompress(data)
    return np.frombuffer(raw, np.dtype(chr(raw[0])), offset=1).astype(kind)


def contains(sorted_keys: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Whether each key is among the sorted ones."""
    if not len(sorted_keys):
        return np.zeros(len(keys), bool)
    return sorted_keys[np.minimum(np.searchsorted(sorted_keys, keys), len(sorted_keys) - 1)] == keys
