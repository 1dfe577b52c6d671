"""Katz backoff language model: Good-Turing discounted counts, exactly normalised backoff weights."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .batches import BATCH_CHARS, RANGE_CHARS, U64, Texts, Words, digest_of, mixed, packed_keys, packed_texts, packed_values, split_by_range, tidied, tidied_pair, total_chars, unpacked_keys, unpacked_values
from .common import fold, fresh, others, table

#: Hashes of the end of a text (a token) and of its begin (a history only).
END, BEGIN = U64(0xE7D1A3C5B9F08642), U64(0x1B873593CC9E2D51)
#: Counts up to this are discounted by Good and Turing's estimate.
KATZ = 5
#: Taken from larger counts, so that a history with frequent successors only leaves something to others.
LARGE = 0.01

QUESTION = "range bigint, batch bigint, keys binary, values binary, stats array<bigint>"
ANSWER = "batch bigint, stage int, range bigint, values binary, stats array<bigint>"
SCORES = "digest binary, n_tokens bigint, n_known bigint, train_tokens bigint, base_score double, score double"


def good_turing(n: list[float]) -> np.ndarray:
    """Katz's factors d[1..KATZ] from n[r], the numbers of kinds seen r times: d_r = (r* / r - C) / (1 - C) with r* = (r + 1) n_{r+1} / n_r
    and C = (KATZ + 1) n_{KATZ+1} / n_1. All 0 where they don't exist."""
    if not all(x > 0 for x in n[1 : KATZ + 2]) or (c := (KATZ + 1) * n[KATZ + 1] / n[1]) >= 1:
        return np.zeros(KATZ)
    return np.array([((r + 1) * n[r + 1] / n[r] / r - c) / (1 - c) for r in range(1, KATZ + 1)])


def smoothed(n: list[int]) -> list[float]:
    """The numbers of kinds by Gale and Sampson's line: log n_r fitted to log r, each n_r spread over the empty counts about it."""
    seen = [r for r in range(1, KATZ + 2) if n[r] > 0]
    if len(seen) < 2:
        return [0.0] * (KATZ + 2)
    before, after = [0, *seen[:-1]], [*seen[1:], 2 * seen[-1] - seen[-2]]
    slope, level = np.polyfit(np.log(seen), [np.log(2 * n[r] / (z - a)) for r, a, z in zip(seen, before, after, strict=True)], 1)
    return [0.0, *np.exp(level + slope * np.log(np.arange(1, KATZ + 2)))]


def discounts(of_counts: list[int]) -> np.ndarray:
    """Factors d[0..KATZ] for the counts, from the numbers of kinds seen 1, 2, ... KATZ + 1 times.

    Good and Turing's estimate (:func:`good_turing`) from the numbers as they are; where a factor is not between 0 and 1 (copies lift single numbers), from the
    smoothed ones, which give such factors whenever the line falls faster than 1 / r. Where it doesn't (hardly any rare kinds), all take off
    n_1 / (n_1 + 2 n_2) instead.
    """
    n = [0, *of_counts]
    for numbers in (n, smoothed(n)):
        d = good_turing(numbers)
        if ((d > 0) & (d < 1)).all():
            return np.array([1.0, *d])
    off = n[1] / (n[1] + 2 * n[2]) if n[1] else 0.5
    off = min(max(off, 0.05), 0.95)
    return np.array([1.0, *((r - off) / r for r in range(1, KATZ + 1))])


def discounted(count: np.ndarray, d: np.ndarray) -> np.ndarray:
    """Discounted counts."""
    return np.where(count > KATZ, count - LARGE, count * d[np.minimum(count, KATZ)])


def kinds(counts: np.ndarray) -> list[int]:
    """Numbers of kinds seen 1, 2, ... KATZ + 1 times."""
    return np.bincount(counts[(counts > 0) & (counts <= KATZ + 1)], minlength=KATZ + 2)[1:].tolist()


def sums_by(keys: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct keys in order, the sum of the values of each, and the place of each row among them."""
    unique, inverse = np.unique(keys, return_inverse=True)
    total = np.zeros(len(unique), values.dtype)
    np.add.at(total, inverse, values)
    return unique, total, inverse


class Tokens:
    """A batch's tokens: words of the lower-cased texts, each text closed by an end; with the word before each."""

    def __init__(self, blobs: list[bytes]):
        self.texts = Texts(blobs)
        w = Words(self.texts.texts, lower=True)
        self.token = np.insert(w.hash, w.first[1:], END)
        self.history = np.insert(w.hash, w.first[:-1], BEGIN)
        self.length = w.count + 1
        weight = np.repeat(self.texts.weights, self.length)
        self.words, self.word_counts, self.word = sums_by(self.token, weight)
        self.pairs, self.pair_counts, self.pair = sums_by(pair_keys(self.history, self.token), weight)
        first = np.empty(len(self.pairs), np.int64)
        first[self.pair[::-1]] = np.arange(len(self.pair))[::-1]
        self.pair_history, self.pair_word = self.history[first], self.word[first]


def pair_keys(history: np.ndarray, token: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        return mixed(history * U64(0xC2B2AE3D27D4EB4F) + token)


def question(batch: int, keys: np.ndarray, values: np.ndarray, n_ranges: int, stats: list[int] | None = None) -> pd.DataFrame:
    """The sorted keys with their values, one row per range; statistics go along with the first."""
    parts = split_by_range(keys, n_ranges) if len(keys) else [(batch % n_ranges, 0, 0)]
    return pd.DataFrame(
        {"range": [r for r, _, _ in parts], "batch": batch, "keys": [packed_keys(keys[a:z]) for _, a, z in parts], "values": [packed_values(values[a:z]) for _, a, z in parts], "stats": [stats if k == 0 else None for k in range(len(parts))]}
    )


def gathered(pdf: pd.DataFrame, kind: type, columns: int = 1) -> tuple[pd.DataFrame, np.ndarray, np.ndarray, np.ndarray]:
    """A range's questions in the order of their batches: rows, their sizes, all keys, all values."""
    pdf = pdf.sort_values("batch")
    keys = [unpacked_keys(x) for x in pdf["keys"]]
    values = np.concatenate([unpacked_values(x, kind) for x in pdf["values"]])
    return pdf, np.array([len(k) for k in keys]), np.concatenate(keys), values if columns == 1 else values.reshape(-1, columns)


def answers(pdf: pd.DataFrame, sizes: np.ndarray, stage: int, values: np.ndarray, stats: list[int] | None) -> pd.DataFrame:
    ends = np.cumsum(sizes)
    rows = [(int(b), stage, int(r), packed_values(values[e - n : e]), None) for b, r, n, e in zip(pdf["batch"], pdf["range"], sizes, ends, strict=True) if n]
    if stats is not None:
        rows.append((-1, stage, -1, None, stats))
    return pd.DataFrame(rows, columns=["batch", "stage", "range", "values", "stats"])


def answer(pdf: pd.DataFrame, stage: int, kind: type) -> np.ndarray:
    """What the ranges sent back for one stage, in the order of the keys asked about."""
    rows = pdf[(pdf["stage"] == stage) & pdf["values"].notna()].sort_values("range")
    return np.concatenate([np.empty(0, kind), *(unpacked_values(x, kind) for x in rows["values"])])


def statistics(pdf: pd.DataFrame, stage: int) -> list[int]:
    return next((list(map(int, x)) for x in pdf["stats"][(pdf["stage"] == stage) & pdf["stats"].notna()]), [])


def words_in_range(pdf: pd.DataFrame) -> pd.DataFrame:
    """Counts of words over all batches: total * 2, plus 1 if other batches have the word too."""
    pdf, sizes, keys, counts = gathered(pdf, np.int64)
    unique, total, place = sums_by(keys, counts)
    shared = np.bincount(place) > 1 if len(place) else np.empty(0, bool)
    return answers(pdf, sizes, 1, (total * 2 + shared)[place], [int(total.sum()), int((total > 0).sum()), *kinds(total)])


def pairs_in_range(pdf: pd.DataFrame) -> pd.DataFrame:
    """Counts of word pairs over all batches: total * 2, plus 1 for the one batch that accounts for the pair."""
    local = [x for x in pdf["stats"] if x is not None]
    pdf, sizes, keys, counts = gathered(pdf, np.int64)
    unique, total, place = sums_by(keys, counts)
    first = np.full(len(unique), len(place), np.int64)
    np.minimum.at(first, place, np.arange(len(place)))
    owner = np.zeros(len(place), np.int64)
    owner[first[total > 0]] = 1
    stats = np.sum([kinds(total), *local], axis=0).astype(int).tolist()
    return answers(pdf, sizes, 2, total[place] * 2 + owner, stats)


def histories_in_range(pdf: pd.DataFrame) -> pd.DataFrame:
    """Per history the sums over its successors, added up in the order of the batches."""
    pdf, sizes, keys, sums = gathered(pdf, np.float64, 2)
    unique, place = np.unique(keys, return_inverse=True)
    total = np.stack([np.bincount(place, weights=sums[:, k], minlength=len(unique)) for k in (0, 1)], axis=1)
    return answers(pdf, sizes, 3, total[place], None)


class Model:
    """What a batch knows of the model after the first two answers."""

    def __init__(self, tokens: Tokens, right: pd.DataFrame):
        self.tokens = t = tokens
        total = answer(right, 1, np.int64)
        self.count, self.shared = total >> 1, (total & 1).astype(bool)
        # a pair is its batch's own if its history or its word is
        position = np.searchsorted(t.words, t.pair_history)
        position = np.minimum(position, len(t.words) - 1)
        self.is_begin = t.pair_history == BEGIN
        self.history_place = np.where(self.is_begin, np.searchsorted(t.words, END), position)  # as many begins as ends
        self.pair_shared = (self.is_begin | self.shared[self.history_place]) & self.shared[t.pair_word]

    def pair_question(self) -> tuple[np.ndarray, np.ndarray, list[int]]:
        t = self.tokens
        return t.pairs[self.pair_shared], t.pair_counts[self.pair_shared], kinds(t.pair_counts[~self.pair_shared])

    def with_pairs(self, right: pd.DataFrame) -> Model:
        t = self.tokens
        asked = answer(right, 2, np.int64)
        self.pair_total, self.mine = t.pair_counts.copy(), t.pair_counts > 0
        self.pair_total[self.pair_shared], self.mine[self.pair_shared] = asked >> 1, (asked & 1).astype(bool)
        self.n_tokens, self.n_words, *of_words = statistics(right, 1)
        d1, self.d2 = discounts(of_words), discounts(statistics(right, 2))
        kept = float(sum(n * r * (1 - d1[r]) for r, n in enumerate(of_words[:KATZ], 1)) + LARGE * (self.n_words - sum(of_words[:KATZ])))
        n = max(self.n_tokens, 1)
        self.unknown = kept / n if self.n_tokens else 1.0
        self.p_word = np.where(self.count > 0, discounted(self.count, d1) / n, self.unknown)
        # sums over the successors that this batch accounts for
        self.histories, place = np.unique(t.pair_history, return_inverse=True)
        w = np.where(self.mine, 1.0, 0.0)
        self.seen = np.bincount(place, weights=w * discounted(self.pair_total, self.d2))
        self.lower = np.bincount(place, weights=w * self.p_word[t.pair_word])
        self.of_pair = place
        first = np.empty(len(self.histories), np.int64)
        first[place] = np.arange(len(place))
        self.history_count = self.count[self.history_place[first]]
        self.history_shared = self.is_begin[first] | self.shared[self.history_place[first]]
        # asked about: histories of pairs never seen, and those with something to add
        unseen = np.bincount(place, weights=self.pair_total == 0) > 0
        self.asked = self.history_shared & (unseen | (self.seen > 0))
        return self

    def scores(self, right: pd.DataFrame) -> pd.DataFrame:
        t = self.tokens
        sums = np.stack([self.seen, self.lower], axis=1)
        sums[self.asked] = answer(right, 3, np.float64).reshape(-1, 2)
        n = np.maximum(self.history_count, 1)
        rest, free = 1 - sums[:, 0] / n, 1 - sums[:, 1]
        weight = np.where(self.history_count > 0, np.maximum(rest, 1e-12) / np.maximum(free, 1e-12), 1.0)
        pair = np.where(self.pair_total > 0, discounted(self.pair_total, self.d2) / n[self.of_pair], weight[self.of_pair] * self.p_word[t.pair_word])
        log_pair = np.log10(pair)
        log_base = np.log10((self.count + 1) / (self.n_tokens + self.n_words + 1))
        ends = np.cumsum(t.length)
        starts = ends - t.length
        return pd.DataFrame(
            {
                "digest": t.texts.digests, "n_tokens": t.length, "n_known": np.add.reduceat(self.count[t.word] > 0, starts, dtype=np.int64), "train_tokens": self.n_tokens,
                "base_score": np.add.reduceat(log_base[t.word], starts), "score": np.add.reduceat(log_pair[t.pair], starts),
            }
        )


def totals(answered: DataFrame, stage: int, n_batches: int) -> DataFrame:
    """The statistics of all ranges summed up, as one row for each batch."""
    parts = answered.filter("batch = -1").select(F.posexplode("stats").alias("k", "n")).groupBy("k").agg(F.sum("n").alias("n"))
    one = parts.agg(F.transform(F.array_sort(F.collect_list(F.struct("k", "n"))), lambda x: x["n"]).alias("stats"))
    return one.select(F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(n_batches - 1).cast("bigint"))).alias("batch"), F.lit(stage).alias("stage"), F.lit(-1).cast("bigint").alias("range"), F.lit(None).cast("binary").alias("values"), "stats")


def score_texts(docs: DataFrame, train: Column, text: str = "text") -> DataFrame:
    """One row per distinct text: digest, n_tokens, n_known, train_tokens, base_score, score (``SCORES``).

    A bigram Katz model over lower-cased words and an end token per text, learned from the rows for which
    ``train`` holds (copies count), scores every text: P(w|h) is the discounted count of hw over that of h if hw was seen, else the
    weight of h times P(w); P(w) likewise falls back to the one unknown word. Weights make every history's
    probabilities sum to 1 over the training words and the unknown word. Words and pairs are told apart by 64-bit hashes.

    Counts are kept by key range (:mod:`batches`): ranges add up words, then pairs, then the sums
    over each history's successors, and answer the batches that asked. Words found in one batch only are settled
    there. What moves grows with the corpus, a frequent word or pair moving once per batch.
    """
    chars = total_chars(docs, text)
    n_batches, n_ranges = -(-chars // BATCH_CHARS) or 1, -(-chars // RANGE_CHARS) or 1
    by_batch = packed_texts(docs, text, n_batches, F.when(train, 1).otherwise(0)).groupBy("batch")

    def ask_words(pdf: pd.DataFrame) -> pd.DataFrame:
        t = Tokens(list(pdf["blob"]))
        return question(int(pdf["batch"].iloc[0]), t.words, t.word_counts, n_ranges)

    def ask_pairs(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        if not len(left):
            return pd.DataFrame(columns=["range", "batch", "keys", "values", "stats"])
        keys, counts, stats = Model(Tokens(list(left["blob"])), right).pair_question()
        return question(int(left["batch"].iloc[0]), keys, counts, n_ranges, stats)

    def ask_histories(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        if not len(left):
            return pd.DataFrame(columns=["range", "batch", "keys", "values", "stats"])
        m = Model(Tokens(list(left["blob"])), right).with_pairs(right)
        return question(int(left["batch"].iloc[0]), m.histories[m.asked], np.stack([m.seen, m.lower], axis=1)[m.asked], n_ranges)

    def score(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        if not len(left):
            return pd.DataFrame(columns=[x.split()[0] for x in SCORES.split(", ")])
        return Model(Tokens(list(left["blob"])), right).with_pairs(right).scores(right)

    words = by_batch.applyInPandas(tidied(ask_words), QUESTION).groupBy("range").applyInPandas(tidied(words_in_range), ANSWER)
    known = words.filter("batch >= 0")
    pairs = by_batch.cogroup(known.groupBy("batch")).applyInPandas(tidied_pair(ask_pairs), QUESTION).groupBy("range").applyInPandas(tidied(pairs_in_range), ANSWER)
    known = known.unionByName(pairs.filter("batch >= 0")).unionByName(totals(words, 1, n_batches)).unionByName(totals(pairs, 2, n_batches))
    histories = by_batch.cogroup(known.groupBy("batch")).applyInPandas(tidied_pair(ask_histories), QUESTION).groupBy("range").applyInPandas(tidied(histories_in_range), ANSWER)
    return by_batch.cogroup(known.unionByName(histories).groupBy("batch")).applyInPandas(tidied_pair(score), SCORES)


def score_documents(docs: DataFrame, train: Column, text: str = "text") -> DataFrame:
    """All rows of ``docs`` with the columns of :func:`score_texts` but the digest. Null texts count as empty ones
    (their one token is the end). Columns of these names are replaced; empty tables give empty results. Repeated rows are scored alike."""
    names = [x.split()[0] for x in SCORES.split(", ")][1:]
    kept = others(docs, names)
    digest, *made = fresh(docs, "_digest", *(f"_{n}" for n in names))
    whole = F.coalesce(F.col(text), F.lit(""))
    scored = score_texts(docs.select(whole.alias("t"), train.alias("learns")), F.col("learns"), "t").toDF(digest, *made)
    keyed = docs.select(*[F.col(f"`{c}`") for c in kept], digest_of(whole).alias(digest))
    return keyed.join(scored, digest, "left").select(*[F.col(f"`{c}`") for c in kept], *[F.col(m).alias(n) for m, n in zip(made, names, strict=True)])


def op8_katz_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    held_out = F.coalesce(fold(F.col("doc_id"), 7) == 2, F.lit(False))
    docs = table(spark, sf_dir, "documents").select("doc_id", "text").withColumn("held_out", held_out)
    scored = score_texts(docs.select(F.coalesce("text", F.lit("")).alias("text"), "held_out"), ~F.col("held_out")).withColumnRenamed("digest", "_digest")
    keyed = docs.select("doc_id", "held_out", digest_of(F.coalesce("text", F.lit(""))).alias("_digest"))
    return keyed.join(scored, "_digest", "left").select("doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score")


#: The same model as plain SQL: words told apart by themselves, crc32 from its rule.
OP8_SQL = r"""
WITH crc AS (SELECT list_transform(range(256), lambda b: list_reduce([b, 0, 0, 0, 0, 0, 0, 0, 0], lambda c, k: CASE WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS t),
docs AS MATERIALIZED (SELECT row_number() OVER () AS rn, doc_id,
  coalesce(xor(list_reduce(list_prepend(4294967295, list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda x: CAST(ascii(x) AS BIGINT))), lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295) % 7 = 2, false) AS held_out,
  list_append(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+'), ' ') AS ws FROM documents, crc),
tokens AS MATERIALIZED (SELECT rn, held_out, ws[i] AS w, CASE WHEN i = 1 THEN '' ELSE ws[i - 1] END AS h FROM (SELECT rn, held_out, ws, unnest(range(1, len(ws) + 1)) AS i FROM docs) x),
words AS MATERIALIZED (SELECT w, count(*) AS c FROM tokens WHERE NOT held_out GROUP BY w),
pairs AS MATERIALIZED (SELECT h, w, count(*) AS c FROM tokens WHERE NOT held_out GROUP BY h, w),
size AS (SELECT coalesce(sum(c), 0) AS n, count(*) AS v FROM words),
seen AS (SELECT 1 AS o, c AS r, count(*) AS n FROM words WHERE c <= 6 GROUP BY c UNION ALL SELECT 2, c, count(*) FROM pairs WHERE c <= 6 GROUP BY c),
steps AS (SELECT o, r, n, lag(r, 1, 0) OVER k AS a, lead(r) OVER k AS z FROM seen WINDOW k AS (PARTITION BY o ORDER BY r)),
line AS (SELECT o, regr_slope(y, ln(r)) AS slope, regr_intercept(y, ln(r)) AS level FROM (SELECT o, r, ln(2.0 * n / (coalesce(z, 2 * r - a) - a)) AS y FROM steps) x GROUP BY o HAVING count(*) > 1),
numbers AS (SELECT o, 1 AS way, list(n * 1e0 ORDER BY r) AS n FROM seen GROUP BY o HAVING count(*) = 6 UNION ALL SELECT o, 2, list_transform(range(1, 7), lambda r: exp(level + slope * ln(r))) FROM line),
turing AS (SELECT o, way, list_transform(range(1, 6), lambda r: ((r + 1) * n[r + 1] / n[r] / r - 6 * n[6] / n[1]) / (1 - 6 * n[6] / n[1])) AS d FROM numbers WHERE 6 * n[6] / n[1] < 1),
flat AS (SELECT o.o, CASE WHEN coalesce(a.n, 0) = 0 THEN 5e-1 ELSE least(greatest(a.n / (a.n + 2e0 * coalesce(b.n, 0)), 5e-2), 95e-2) END AS off FROM (SELECT unnest([1, 2]) AS o) o LEFT JOIN seen a ON a.o = o.o AND a.r = 1 LEFT JOIN seen b ON b.o = o.o AND b.r = 2),
ways AS (SELECT o, way, d FROM turing WHERE list_min(d) > 0 AND list_max(d) < 1 UNION ALL SELECT o, 3, list_transform(range(1, 6), lambda r: (r - off) / r) FROM flat),
discounts AS (SELECT o, arg_min(d, way) AS d FROM ways GROUP BY o),
word_p AS MATERIALIZED (SELECT w, c, CASE WHEN c <= 5 THEN c * d[c] ELSE c - 1e-2 END / n AS p, (c - CASE WHEN c <= 5 THEN c * d[c] ELSE c - 1e-2 END) / n AS freed FROM words, size, discounts WHERE o = 1),
unknown AS (SELECT coalesce(sum(freed), 1e0) AS p FROM word_p),
pair_p AS MATERIALIZED (SELECT h, pairs.w, CASE WHEN pairs.c <= 5 THEN pairs.c * d[pairs.c] ELSE pairs.c - 1e-2 END AS kept, p FROM pairs JOIN word_p ON word_p.w = pairs.w, discounts WHERE o = 2),
histories AS (SELECT h, c AS n, greatest(1 - kept / c, 1e-12) / greatest(1 - lower_p, 1e-12) AS weight FROM (SELECT h, sum(kept) AS kept, sum(p) AS lower_p FROM pair_p GROUP BY h) x JOIN words ON words.w = CASE WHEN h = '' THEN ' ' ELSE h END),
scored AS (SELECT t.rn, count(*) AS n_tokens, count(u.c) AS n_known, sum(log10((coalesce(u.c, 0) + 1e0) / (size.n + v + 1))) AS base_score,
  sum(log10(CASE WHEN b.kept IS NOT NULL THEN b.kept / g.n ELSE coalesce(g.weight, 1e0) * coalesce(u.p, unknown.p) END)) AS score
  FROM tokens t LEFT JOIN word_p u ON u.w = t.w LEFT JOIN pair_p b ON b.h = t.h AND b.w = t.w LEFT JOIN histories g ON g.h = t.h, size, unknown GROUP BY t.rn)
SELECT doc_id, held_out, CAST(n_tokens AS BIGINT) AS n_tokens, CAST(n_known AS BIGINT) AS n_known, CAST(n AS BIGINT) AS train_tokens, base_score, score FROM docs JOIN scored USING (rn), size
"""
