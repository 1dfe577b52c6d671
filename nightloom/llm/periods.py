"""Periodic runs of words in texts: common extensions over difference-cover samples, asked on a grid of harmonic density."""

from __future__ import annotations

from collections.abc import Iterator
from functools import cached_property

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import WORD, add_columns, fresh, others, table

#: A perfect difference set. Each difference modulo PERIOD is that of two of its members.
PERIOD, COVER = 31, (1, 5, 11, 24, 25, 27)
#: Words that are looked at together, and pairs of places.
CHUNK_WORDS, CHUNK_PAIRS = 1 << 18, 1 << 19


def matched(w: np.ndarray, i: np.ndarray, j: np.ndarray, most: int | np.ndarray, step: int = 1) -> np.ndarray:
    """How many words from ``i`` and ``j`` on (or back, with ``step`` -1) are the same, up to ``most``."""
    length = np.zeros(len(i), np.int64)
    limits = np.broadcast_to(np.asarray(most, np.int64), len(i))
    left = np.flatnonzero(limits > 0)
    t = 0
    while len(left):
        left = left[w[i[left] + t * step] == w[j[left] + t * step]]
        t += 1
        length[left] = t
        left = left[limits[left] > t]
    return length


class CommonExtensions:
    """Longest common prefixes of suffixes of ``w``, which ends in a word that stands nowhere else, as texts in it do.

    Only suffixes that start in the cover (modulo ``PERIOD``) are sorted: by their first words, then by doubling, as a sample ``PERIOD`` further on is one too. Two
    other suffixes compare at most ``PERIOD`` - 1 words until both stand at samples, whose common prefix is a range's least entry of the samples' prefix table.
    """

    def __init__(self, w: np.ndarray):
        self.w, n, c = w, len(w), len(COVER)
        place = np.full(PERIOD, -1)
        place[list(COVER)] = range(c)
        self.place = place
        self.start = np.full(PERIOD, COVER[0])
        for a in COVER:
            for b in COVER:
                if a != b:
                    self.start[(b - a) % PERIOD] = a
        self.at = np.flatnonzero(place[np.arange(n) % PERIOD] >= 0)
        m = len(self.at)
        padded = np.concatenate([w, np.full(PERIOD, np.iinfo(np.int32).min, np.int32)]).astype(np.int32)
        first = np.ascontiguousarray(np.lib.stride_tricks.sliding_window_view(padded, PERIOD)[self.at]).view(f"V{4 * PERIOD}").ravel()
        ranks = [np.unique(first, return_inverse=True)[1].astype(np.int64).ravel()]
        while m and int(ranks[-1].max()) < m - 1:
            ahead = c << len(ranks) - 1
            after = np.zeros(m, np.int64)
            if ahead < m:
                after[:-ahead] = ranks[-1][ahead:] + 1
            ranks.append(np.unique(ranks[-1] * (m + 1) + after, return_inverse=True)[1].astype(np.int64).ravel())
        self.rank = ranks[-1] if m else np.zeros(0, np.int64)
        order = np.empty(m, np.int64)
        order[self.rank] = np.arange(m)
        x, y = order[:-1].copy(), order[1:].copy()
        length = np.zeros(len(x), np.int64)
        for k in range(len(ranks) - 1, -1, -1):
            inside = np.flatnonzero((x < m) & (y < m))
            same = inside[ranks[k][x[inside]] == ranks[k][y[inside]]]
            x[same] += c << k
            y[same] += c << k
            length[same] += PERIOD << k
        length += matched(w, self.at[order[:-1]] + length, self.at[order[1:]] + length, PERIOD)
        self.least = [length.astype(np.int32)]
        while 2 << len(self.least) - 1 <= len(length):
            half = 1 << len(self.least) - 1
            self.least.append(np.minimum(self.least[-1][:-half], self.least[-1][half:]))

    def ask(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """The common prefixes' lengths of the suffixes at ``i`` and ``j``, which differ."""
        wait = (self.start[(j - i) % PERIOD] - i) % PERIOD
        length = matched(self.w, i, j, wait)
        far = np.flatnonzero(length == wait)
        if len(far):
            a, b = (self.rank[(p // PERIOD) * len(COVER) + self.place[p % PERIOD]] for p in (i[far] + wait[far], j[far] + wait[far]))
            low, high = np.minimum(a, b), np.maximum(a, b)
            level = np.frexp((high - low).astype(np.float64))[1] - 1
            least = np.empty(len(far), np.int64)
            for k in np.unique(level):
                on = np.flatnonzero(level == k)
                least[on] = np.minimum(self.least[k][low[on]], self.least[k][high[on] - (1 << k)])
            length[far] += least
        return length


class Joined:
    """Texts' words as numbers in one array, with a word of its own before, between and after them."""

    def __init__(self, texts: list[np.ndarray]):
        self.sizes = np.array([len(t) for t in texts], np.int64)
        self.first = np.cumsum(self.sizes + 1) - self.sizes  # of each text's words
        w = np.empty(int(self.sizes.sum()) + len(texts) + 1, np.int32)
        w[0] = -1
        for k, (t, at) in enumerate(zip(texts, self.first.tolist(), strict=True)):
            w[at : at + len(t)] = t
            w[at + len(t)] = -2 - k
        self.w = w

    @cached_property
    def ahead(self) -> CommonExtensions:
        return CommonExtensions(self.w)

    @cached_property
    def back(self) -> CommonExtensions:
        return CommonExtensions(self.w[::-1].copy())

    def grid(self, least: int, times: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """(text, place, period) such that every run has one of its first places with the same word a period on: places a run's least length less a period apart.
        Their number is harmonic, n / 2 log n. Only those whose word comes again a period on are given."""
        texts = np.flatnonzero(self.sizes >= least)
        counts = self.sizes[texts] // times
        text = np.repeat(texts, counts)
        period = np.arange(len(text)) - np.repeat(np.cumsum(counts) - counts, counts) + 1
        gap = np.maximum(least - period, (times - 1) * period)
        points = (self.sizes[text] - period) // gap
        ends = np.cumsum(points)
        at = 0
        while at < len(text):
            done = int(ends[at - 1]) if at else 0
            stop = max(at + 1, int(np.searchsorted(ends, done + CHUNK_PAIRS, "right")))
            rows = np.repeat(np.arange(at, stop), points[at:stop])
            k = np.arange(len(rows)) - (np.repeat(ends[at:stop] - points[at:stop], points[at:stop]) - done)
            i = self.first[text[rows]] + (k + 1) * gap[rows] - 1
            same = np.flatnonzero(self.w[i] == self.w[i + period[rows]])
            yield text[rows[same]], i[same], period[rows[same]]
            at = stop

    def runs(self, least: int, times: int) -> tuple[np.ndarray, ...]:
        """(text, start, length, period) of all runs, in that order. Texts in which no two places agree for long are settled by comparing words; the others are sorted."""
        deep = np.zeros(len(self.sizes), bool)
        near: list[tuple] = []
        for text, i, q in self.grid(least, times):
            right, left = matched(self.w, i, i + q, PERIOD), matched(self.w, i - 1, i - 1 + q, PERIOD, -1)
            deep[text[(right == PERIOD) | (left == PERIOD)]] = True
            near.append(kept_runs(text, i - left, left + right + q, q, least, times))
        found = [x[~deep[x[:, 0]]] for x in near]
        if deep.any():
            which = np.flatnonzero(deep)
            part = Joined([self.w[self.first[k] : self.first[k] + self.sizes[k]] for k in which])
            n = len(part.w)
            for text, i, q in part.grid(least, times):
                right, left = part.ahead.ask(i, i + q), part.back.ask(n - i - q, n - i)
                rows = kept_runs(text, i - left, left + right + q, q, least, times)
                rows[:, 1] += self.first[which[rows[:, 0]]] - part.first[rows[:, 0]]
                rows[:, 0] = which[rows[:, 0]]
                found.append(rows)
        rows = np.concatenate(found) if found else np.empty((0, 4), np.int64)
        # a stretch that keeps a period keeps its multiples; each is a run of the smallest, which comes first here
        rows = rows[np.lexsort((rows[:, 3], rows[:, 2], rows[:, 1], rows[:, 0]))]
        new = np.ones(len(rows), bool)
        new[1:] = (rows[1:, :3] != rows[:-1, :3]).any(axis=1)
        rows = rows[new]
        rows[:, 1] -= self.first[rows[:, 0]]
        return tuple(rows[np.lexsort((rows[:, 3], rows[:, 1], rows[:, 0]))].T)


def kept_runs(text: np.ndarray, start: np.ndarray, length: np.ndarray, period: np.ndarray, least: int, times: int) -> np.ndarray:
    """Those long enough, each once."""
    ok = length >= np.maximum(least, times * period)
    return np.unique(np.stack([text[ok], start[ok], length[ok], period[ok]], axis=1), axis=0)


def runs_of(texts: list[str | None], least: int, times: int) -> list[list]:
    """Per text its runs, number of words, and kept words joined by spaces."""
    runs: list = [[] for _ in texts]
    counts, kept = [0] * len(texts), [""] * len(texts)

    def settle(which: list[int], words: list[list[bytes]]) -> None:
        number: dict[bytes, int] = {}
        joined = Joined([np.fromiter((number.setdefault(x, len(number)) for x in ws), np.int32, len(ws)) for ws in words])
        text, start, length, period = joined.runs(least, times)
        bounds = np.searchsorted(text, np.arange(len(which) + 1))
        for k, ws in enumerate(words):
            a, z = bounds[k], bounds[k + 1]
            if a < z:
                s, n, q = start[a:z], length[a:z], period[a:z]
                edges = np.zeros(len(ws) + 1, np.int64)
                np.add.at(edges, s + q, 1)
                np.add.at(edges, s + n, -1)
                stays = np.cumsum(edges[:-1]) == 0
                runs[which[k]] = [{"start": i, "length": m, "period": p} for i, m, p in zip(s.tolist(), n.tolist(), q.tolist(), strict=True)]
                ws = [x for x, ok in zip(ws, stays.tolist(), strict=True) if ok]
            kept[which[k]] = b" ".join(ws).decode("utf-8", "surrogatepass")

    held: list[int] = []
    split: list[list[bytes]] = []
    size = 0
    for k, t in enumerate(texts):
        ws = t.encode("utf-8", "surrogatepass").split() if t else []  # bytes split at ASCII white space alone
        counts[k] = len(ws)
        if size and size + len(ws) > CHUNK_WORDS:
            settle(held, split)
            held, split, size = [], [], 0
        held.append(k)
        split.append(ws)
        size += len(ws)
    if held:
        settle(held, split)
    return [runs, counts, kept]


def find_runs(docs: DataFrame, text: str = "text", least: int = 24, times: int = 3) -> DataFrame:
    """All rows with ``runs`` (array of start, length, period, by start and period), ``n_words`` and ``kept_text``.

    Words stand between ASCII white space. A run is a stretch of at least ``least`` words and ``times`` (2 or more) of its smallest period that no neighbouring word extends. ``kept_text``
    is the words, joined by spaces, without those that a run holds after its first period. Each row is computed by itself, without a shuffle; a text is held whole by one task,
    at about a hundred bytes a word where words repeat at length, and time grows as n log n words whatever repeats in it.

    Null and empty texts have no words, no runs and an empty ``kept_text``. Repeated rows are computed alike, empty tables stay empty; columns of the new names are replaced, others pass as they are.
    """
    return add_columns(docs, text, "runs array<struct<start: bigint, length: bigint, period: bigint>>, n_words bigint, kept_text string", lambda: lambda values: runs_of(values, least, times))


def looped(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` where a tenth of the texts, chosen by the crc32 of their id, end in a loop of their own words: from word a = g % n on, word i becomes word a + (i - a) % p,
    with g a tenth of the crc32, n the words and p = 1 + floor((n - a) / (3 + g % 8)). Other texts, and rows without id, stay as they are."""
    h, w, out = fresh(docs, "_hash", "_words", "_looped")
    crc = F.crc32(F.col(doc_id).cast("string").cast("binary"))
    made = docs.withColumn(h, crc).withColumn(w, F.when(F.col(h) % 10 == 0, F.regexp_extract_all(F.coalesce(F.col(text), F.lit("")), F.lit(WORD), F.lit(0))))
    n, g = F.size(w), F.floor(F.col(h) / 10)
    a = F.pmod(g, n).cast("int")
    p = (1 + F.floor((n - a) / (3 + g % 8))).cast("int")
    loop = F.flatten(F.array_repeat(F.slice(w, a + 1, p), F.ceil((n - a) / p).cast("int")))
    whole = F.array_join(F.concat(F.slice(w, F.lit(1), a), F.slice(loop, F.lit(1), n - a)), " ")
    made = made.withColumn(out, F.when(F.col(w).isNotNull() & (F.size(w) > 0), whole).otherwise(F.col(text)))
    return made.select(*[F.col(f"`{c}`") for c in others(docs, (text,))], F.col(out).alias(text))


def strongest(runs: Column) -> Column:
    """The run of greatest length to period; of equal ones the first. Whole numbers are compared, so ties are exact."""
    better = lambda best, x: F.when(x["length"] * best["period"] > best["length"] * x["period"], x).otherwise(best)
    return F.when(F.size(runs) > 0, F.aggregate(F.slice(runs, 2, 1 << 30), F.get(runs, 0), better))


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find_runs(looped(table(spark, sf_dir, "documents").select("doc_id", "text"))).withColumn("best", strongest(F.col("runs")))
    lines = F.transform("runs", lambda x: F.concat(x["start"].cast("string"), F.lit(","), x["length"].cast("string"), F.lit(","), x["period"].cast("string"), F.lit("\n")))
    return found.select(
        "doc_id", F.size("runs").cast("bigint").alias("n_runs"), F.col("best.start").alias("start"), F.col("best.length").alias("length"), F.col("best.period").alias("period"),
        F.expr("1000 * best.length div best.period").alias("exponent_milli"), F.sha2(F.array_join(lines, "").cast("binary"), 256).alias("runs_sha256"), F.sha2(F.col("kept_text").cast("binary"), 256).alias("collapsed_sha256"),
    )
