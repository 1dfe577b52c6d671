"""Benchmark decontamination: q-gram lemma filtering in diagonal bands, then banded alignment."""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .batches import contains, digest_of
from .common import add_columns, checkpointed, fresh, others, table

#: Characters of benchmark windows that one pass over the documents takes; more make more passes.
BLOCK_CHARS = 4 << 20


@lru_cache(1)
def word_points() -> np.ndarray:
    """Whether each code point is a letter or digit."""
    return np.fromiter((chr(p).isalnum() for p in range(0x110000)), bool, 0x110000)


def normal(text: str | None) -> np.ndarray:
    """Code points in lower case, each run of others than letters and digits as one space, none at the ends."""
    if not text:
        return np.empty(0, np.uint32)
    points = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32)
    word = word_points()[points]
    keep = word.copy()
    keep[1:] |= word[:-1]
    out = np.where(word, points, np.uint32(32))[keep]
    return out[:-1] if len(out) and out[-1] == 32 else out


def qgrams(text: np.ndarray, q: int) -> np.ndarray:
    """A 64-bit hash of the q-gram at each position, put together from those of half the length."""
    n = len(text) - q + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    with np.errstate(over="ignore"):
        power, length, code, done = text.astype(np.uint64) + np.uint64(1), 1, None, 0
        rest = q
        while rest:
            if rest & 1:
                code = power[done : done + n] if code is None else mixed(code * np.uint64(0x9E3779B97F4A7C15) + power[done : done + n])
                done += length
            rest >>= 1
            if rest:
                power = mixed(power[:-length] * np.uint64(0xD6E8FEB86659FD93) + power[length:])
                length *= 2
        return mixed(code)


def mixed(code: np.ndarray) -> np.ndarray:
    return code ^ code >> np.uint64(29)


def windows_of(length: int, window: int, step: int) -> list[tuple[int, int]]:
    """Parts of an item that are looked for on their own: windows every ``step`` characters, the last one at the end; short items whole."""
    if length <= window:
        return [(0, length)] if length else []
    starts = list(range(0, length - window, step)) + [length - window]
    return [(a, a + window) for a in starts]


def padded(text: np.ndarray) -> np.ndarray:
    """A space at both ends, so that words at the ends have borders too."""
    return np.concatenate([[np.uint32(32)], text, [np.uint32(32)]]).astype(np.uint32)


class QgramIndex:
    """The q-grams of some benchmark windows (item, start, characters), sorted by hash; those under ``shortest`` characters as whole keys."""

    def __init__(self, windows: list[tuple[int, int, str]], q: int, rate: float, shortest: int):
        self.q, self.rate = q, rate
        points = [(i, a, np.frombuffer(t.encode("utf-32-le", "surrogatepass"), np.uint32)) for i, a, t in windows]
        self.parts = [p for p in points if len(p[2]) >= shortest]
        grams = [qgrams(p[2], q) for p in self.parts]
        hashes = np.concatenate([np.empty(0, np.uint64), *grams])
        order = np.argsort(hashes, kind="stable")
        self.hashes = hashes[order]
        self.part = np.repeat(np.arange(len(grams), dtype=np.int32), [len(g) for g in grams])[order]
        self.offset = np.concatenate([np.empty(0, np.int32), *(np.arange(len(g), dtype=np.int32) for g in grams)])[order]
        self.sizes = np.array([len(p[2]) for p in self.parts], np.int64)
        self.edits = np.array([self.budget(n) for n in self.sizes.tolist()], np.int64)
        self.longest = max((len(p[2]) for p in self.parts), default=0)
        self.least = min((max(1, self.needed(len(p[2]))) for p in self.parts), default=1)  # shared q-grams of any match
        self.seen = np.zeros(1 << 22, bool)
        self.seen[(self.hashes & np.uint64((1 << 22) - 1)).astype(np.int64)] = True
        self.short: dict[int, tuple[np.ndarray, list]] = {}  # by length: hashes in order, the windows in that order
        for n in sorted({len(p[2]) for p in points if len(p[2]) < shortest}):
            those = [(i, a, padded(t)) for i, a, t in points if len(t) == n]
            keys = np.concatenate([qgrams(t, n + 2) for _, _, t in those])
            order = np.argsort(keys, kind="stable")
            self.short[n] = keys[order], [those[k] for k in order]

    def needed(self, length: int) -> int:
        """Q-grams that a stretch within the budget shares with a window at least."""
        return length - self.q + 1 - self.budget(length) * self.q

    def budget(self, length: int) -> int:
        """Edits allowed in a window of so many characters."""
        return int(self.rate * length)

    def matches(self, raw: str | None) -> list[tuple[int, int, int, int, int]]:
        """(item, start in the item, edits, start and end in the normal text) of each window found in a text.

        By the q-gram lemma a stretch within ``k`` edits of a window of ``m`` characters shares at least m - q + 1 - k * q of its
        q-grams, on diagonals at most k apart. Bands of 2k + 1 diagonals start every k + 1, so such a stretch
        lies in one of them whole. Bands with fewer different shared q-grams are left; the others are aligned.
        """
        text = normal(raw)
        return sorted({*self._short_matches(text), *self._long_matches(text)})

    def _short_matches(self, text: np.ndarray) -> Iterator[tuple[int, int, int, int, int]]:
        """Short windows that stand in the text as they are, from one word's border to another's."""
        if not len(text) or not self.short:
            return
        whole = padded(text)
        for n, (keys, those) in self.short.items():
            grams = qgrams(whole, n + 2)
            for at in np.flatnonzero(contains(keys, grams)).tolist():
                for k in range(int(np.searchsorted(keys, grams[at], "left")), int(np.searchsorted(keys, grams[at], "right"))):
                    item, start, pattern = those[k]
                    if (pattern == whole[at : at + n + 2]).all():
                        yield item, start, 0, at, at + n

    def _long_matches(self, text: np.ndarray) -> set[tuple[int, int, int, int, int]]:
        grams = qgrams(text, self.q)
        if not len(grams) or not len(self.hashes):
            return set()
        maybe = np.flatnonzero(self.seen[(grams & np.uint64((1 << 22) - 1)).astype(np.int64)])
        low = np.searchsorted(self.hashes, grams[maybe], "left")
        count = np.searchsorted(self.hashes, grams[maybe], "right") - low
        there = count > 0
        where, low, count = maybe[there], low[there], count[there]
        if len(where) < self.least:
            return set()
        # a text is taken in slices of hits, so that a text of repeats stays in bounded memory
        found, ends = set(), np.cumsum(count)
        cuts = np.unique(np.concatenate([np.searchsorted(ends, np.arange(0, ends[-1], 4_000_000), "left"), [len(count)]]))
        regions = set()
        for a, b in zip(cuts, cuts[1:], strict=False):
            back = int(np.searchsorted(where, where[a] - 2 * self.longest))
            regions |= self._regions(where[back:b], low[back:b], count[back:b])
        for p, diagonal, width in sorted(regions):
            item, start, pattern = self.parts[p]
            k = self.budget(len(pattern))
            a, b = max(0, diagonal - k), min(len(text), diagonal + width + len(pattern) + k)
            edits, end = banded(pattern, text[a:b], k)
            if edits is not None:
                found.add((item, start, edits, max(0, a + end - len(pattern)), a + end))
        return found

    def _regions(self, where: np.ndarray, low: np.ndarray, count: np.ndarray) -> set[tuple[int, int, int]]:
        hit = np.repeat(low, count) + np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
        part, offset = self.part[hit].astype(np.int64), self.offset[hit].astype(np.int64)
        diagonal = np.repeat(where, count) - offset
        sizes, edits = self.sizes, self.edits
        k, m = edits[part], sizes[part]
        band = (diagonal + m) // (k + 1)  # of the band that starts here, and of the one before
        out = set()
        for shift in (0, 1):
            key = part << 36 | (band - shift + 1)
            order = np.lexsort((offset, key))
            keys, offsets = key[order], offset[order]
            fresh = np.ones(len(keys), bool)  # each q-gram of a window counts once in a band
            fresh[1:] = (keys[1:] != keys[:-1]) | (offsets[1:] != offsets[:-1])
            keys, n = np.unique(keys[fresh], return_counts=True)
            p = keys >> 36
            need = np.maximum(1, sizes[p] - self.q + 1 - edits[p] * self.q)
            for key_, p_ in zip(keys[n >= need].tolist(), p[n >= need].tolist(), strict=True):
                b = (key_ & ((1 << 36) - 1)) - 1
                out.add((p_, int(b * (edits[p_] + 1) - sizes[p_]), int(2 * edits[p_] + 1)))
        return out


def banded(pattern: np.ndarray, text: np.ndarray, k: int) -> tuple[int | None, int]:
    """Fewest edits between the pattern and any stretch of the text, with that stretch's end; None if over ``k``.

    The rows of the alignment run over the pattern; only the text around the band is given, so the work is the
    pattern's length times the band's width. Insertions along a row are one running minimum.
    """
    n = len(text)
    at = text.tobytes().find(pattern.tobytes())
    if at >= 0 and at % 4 == 0:  # no edits
        return 0, at // 4 + len(pattern)
    row = np.zeros(n + 1, np.int32)
    index = np.arange(n + 1, dtype=np.int32)
    for i, c in enumerate(pattern.tolist(), 1):
        step = np.empty(n + 1, np.int32)
        step[0] = i
        np.minimum(row[:-1] + (text != c), row[1:] + 1, out=step[1:])
        row = np.minimum.accumulate(step - index) + index
        if row.min() > k:
            return None, 0
    end = int(np.argmin(row))
    return (int(row[end]), end) if row[end] <= k else (None, 0)


MATCHES = "array<struct<item: bigint, item_start: int, edits: int, start: int, end: int>>"


def benchmark_windows(benchmark: DataFrame, item_id: str, item_text: str, window: int, step: int) -> DataFrame:
    """(item, start, pattern): the different windows of all items, in normal characters."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for item, raw in zip(batch["i"], batch["t"], strict=True):
                text = normal(raw)
                if not (parts := windows_of(len(text), window, step)):
                    continue
                yield pd.DataFrame({"item": item, "start": [a for a, _ in parts], "pattern": [text[a:b].tobytes().decode("utf-32-le", "surrogatepass") for a, b in parts]})

    items = benchmark.select(F.col(item_id).cast("bigint").alias("i"), F.col(item_text).alias("t")).filter("i is not null and t is not null")
    return items.mapInPandas(run, "item bigint, start int, pattern string").distinct()


def find_benchmark(
    docs: DataFrame, benchmark: DataFrame, text: str = "text", item_id: str = "item_id", item_text: str = "text", q: int = 12, window: int = 60, step: int = 20, rate: float = 0.06, shortest: int = 40
) -> DataFrame:
    """Add ``matches`` to every row: each benchmark window found in its whole text.

    Texts are compared in lower case with all but letters and digits as single spaces. Items longer than ``window`` are looked for in
    windows that start every ``step`` characters, so a word-for-word quotation of ``window + step - 1`` characters holds one whole, wherever
    it starts. A window is found if some stretch of the text is within ``rate`` edits a character; an item
    under ``shortest`` characters, where an edit would soon mean another item, if it stands in the text as it is, between borders of words.

    The benchmark's windows are dealt into blocks of about ``BLOCK_CHARS`` characters by a hash; the index of a block is
    broadcast and all documents run past it. Documents are not shuffled where one block holds the benchmark. Else each block's
    findings are written before the next index is made, so that neither a task nor the driver ever holds more than one, and joined to
    the documents by the text's digest at the end.

    Null or empty texts and items match nothing; repeated items are found under each id; items with a null id
    are left out. All rows stay, repeated ones alike, and empty tables stay empty; a column named ``matches`` is replaced. A text of any length is read whole, in time linear in it but for what it shares with items.
    """
    windows = checkpointed(benchmark_windows(benchmark, item_id, item_text, window, step))
    chars = windows.agg(F.coalesce(F.sum(F.char_length("pattern")), F.lit(0)).alias("n")).first()["n"]
    n_blocks = -(-chars // BLOCK_CHARS) or 1
    if n_blocks == 1:
        return with_matches(docs, windows, text, "matches", q, rate, shortest)
    names = others(docs, ("matches",))
    digest, found = fresh(docs, "_digest", "_found")
    texts = docs.filter(F.col(text).isNotNull()).select(F.col(text).alias("t"), digest_of(F.col(text)).alias(digest))
    parts = None
    for block in range(n_blocks):
        mine = windows.filter(F.pmod(F.xxhash64("item", "start", "pattern"), F.lit(n_blocks)) == block)
        hits = with_matches(texts, mine, "t", found, q, rate, shortest).filter(F.size(found) > 0).select(digest, found)
        hits = checkpointed(hits.groupBy(digest).agg(F.first(found).alias(found)))  # copies of a text have the same
        parts = hits if parts is None else parts.unionByName(hits)
    whole = parts.groupBy(digest).agg(F.array_sort(F.flatten(F.collect_list(found))).alias(found))  # an entry a block
    kept = [F.col(f"`{c}`") for c in names]
    none = F.array().cast(MATCHES)
    keyed = docs.filter(F.col(text).isNotNull()).select(*kept, digest_of(F.col(text)).alias(digest)).join(whole, digest, "left")
    return keyed.select(*kept, F.coalesce(found, none).alias("matches")).unionByName(docs.filter(F.col(text).isNull()).select(*kept, none.alias("matches")))


def with_matches(docs: DataFrame, windows: DataFrame, text: str, column: str, q: int, rate: float, shortest: int) -> DataFrame:
    """Add the matches with one block of windows, whose size is checked by the caller."""
    part = sorted((r["item"], r["start"], r["pattern"]) for r in windows.collect())
    index = docs.sparkSession.sparkContext.broadcast(QgramIndex(part, q, rate, shortest))
    names = ("item", "item_start", "edits", "start", "end")

    def start():
        return lambda texts: [[[dict(zip(names, m, strict=True)) for m in index.value.matches(t)] for t in texts]]

    return add_columns(docs, text, f"`{column}` {MATCHES}", start)


def op1_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per contaminated document and benchmark item: doc_id, item_id, contaminated (true), n_windows found, fewest edits, and where
    in the normal text the first and last window lie. Clean documents have no row."""
    found = find_benchmark(table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "benchmark"))
    each = found.select("doc_id", "matches", F.explode(F.array_distinct(F.transform("matches", lambda m: m["item"]))).alias("item_id"))
    mine = each.select("doc_id", "item_id", F.filter("matches", lambda m: m["item"] == F.col("item_id")).alias("m"))
    of = lambda field: F.transform("m", lambda m: m[field])
    return mine.select(
        "doc_id", "item_id", F.lit(True).alias("contaminated"), F.size("m").cast("bigint").alias("n_windows"), F.array_min(of("edits")).alias("least_edits"),
        F.array_min(of("start")).alias("first_start"), F.array_max(of("end")).alias("last_end"),
    )
