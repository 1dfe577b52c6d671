"""Mixing, repeats, near duplicates, language model and the pipeline against brute force on small tables."""

import collections
import math
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from nightloom.llm import lm, mixing, neardups, substrings

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def words(text):
    return WORD.findall(text or "")


@pytest.fixture
def small_batches(monkeypatch):
    """Many batches and ranges even on small tables."""
    for module in (lm, neardups, substrings):
        monkeypatch.setattr(module, "BATCH_CHARS", 3000)
        monkeypatch.setattr(module, "RANGE_CHARS", 9000)
    monkeypatch.setattr(neardups, "BLOCK", 3)


# 5


def targets(sizes, weights, share, cap):
    order = sorted((s for s in sizes if s is not None)) + [None] * (None in sizes)
    w = {s: weights[k % len(weights)] for k, s in enumerate(order)}
    out, left, open_ = {}, share * sum(sizes.values()), set(order)
    while open_:
        total = sum(w[s] for s in open_)
        full = {s for s in open_ if left * w[s] / total >= cap * sizes[s]}
        if not full:
            return out | {s: left * w[s] / total for s in open_}
        for s in full:
            out[s] = cap * sizes[s]
            left -= out[s]
        open_ -= full
    return out


def test_mix(spark, docs, empty):
    rows = mixing.mix_sources(docs).collect()
    sizes = collections.Counter()
    for x in docs.collect():
        sizes[x.source] += len(words(x.text))
    want = targets(sizes, (3, 1, 2), 1.5, 2)
    assert len(rows) == docs.count()
    taken, longest = collections.Counter(), collections.Counter()
    for x in rows:
        assert x.source_size == sizes[x.source] and x.target == pytest.approx(want[x.source]) and 0 <= x.taken <= 2 * x.size and x.taken == x.copies * x.size
        taken[x.source] += x.taken
        longest[x.source] = max(longest[x.source], x.size)
    for s in sizes:
        assert abs(taken[s] - want[s]) <= longest[s] + 1, s
    key = lambda x: repr(x)
    assert sorted(map(key, rows)) == sorted(map(key, mixing.mix_sources(docs.repartition(3)).collect()))
    assert mixing.mix_sources(empty).count() == 0


def test_mix_solves_the_dual(spark):
    df = spark.createDataFrame([(k, "w " * (1 + k % 37), f"s{k % 2}") for k in range(400)], "doc_id bigint, text string, source string")
    rows = mixing.mix_sources(df, weights=(1, 3), share=1.0).collect()
    for s in ("s0", "s1"):
        mine = [x for x in rows if x.source == s]
        if mine[0].target < 2 * mine[0].source_size:
            assert sum(x.rate * x.size for x in mine) == pytest.approx(mine[0].target, rel=1e-6)
            tilt = {x.size: math.log(x.rate / (2 - x.rate)) / x.size for x in mine}
            assert np.ptp(list(tilt.values())) < 1e-6  # one multiplier per source


def test_mix_by_bisection(spark, docs):
    """Every rate of the mix against multipliers found source by source with plain bisection."""
    rows = mixing.mix_sources(docs).collect()
    by_source = collections.defaultdict(list)
    for x in rows:
        by_source[x.source].append(x)
    for mine in by_source.values():
        sizes = np.array([x.size for x in mine], float)
        total, target, mean = sizes.sum(), mine[0].target, sizes.sum() / len(sizes)
        if not total:
            assert all(x.rate == 0 for x in mine)
            continue
        rates = lambda lam: 2 / (1 + np.exp(np.clip(-lam * sizes / mean, -700, 700)))  # noqa: B023, E731
        if target >= 2 * total:
            want = np.full(len(sizes), 2.0)
        else:
            low, high = -1e6, 1e6
            for _ in range(200):
                low, high = ((low + high) / 2, high) if (rates((low + high) / 2) * sizes).sum() < target else (low, (low + high) / 2)
            want = rates(low)
        assert [x.rate for x in mine] == pytest.approx(np.where(sizes > 0, want, 0).tolist(), abs=1e-6)


def test_mix_with_extreme_targets(spark):
    """A source that must shrink to almost nothing is solved; a target that can't be met is an error."""
    df = spark.createDataFrame([(k, "w " * n, s) for k, (n, s) in enumerate([(1, "a")] * 5 + [(4000, "a"), (3, "b"), (2, "b")])], "doc_id bigint, text string, source string")
    for x in mixing.mix_sources(df, weights=(1, 1), share=0.002).collect():
        assert abs(x.target - 4.005) < 0.01 and 0 <= x.copies <= 2
    with pytest.raises(ArithmeticError):
        mixing.mix_sources(df, weights=(1, 1), share=0.01, steps=1).count()


# 6


def without_repeats(texts, n):
    split = [words(t) for t in texts]
    seen = collections.Counter(tuple(w[k : k + n]) for w in split for k in range(len(w) - n + 1))
    out = []
    for w in split:
        gone = [False] * len(w)
        for k in range(len(w) - n + 1):
            if seen[tuple(w[k : k + n])] > 1:
                gone[k : k + n] = [True] * n
        out.append((len(w), sum(gone), " ".join(x for x, g in zip(w, gone, strict=True) if not g)))
    return out


@pytest.mark.parametrize("window", [1, 2, 5, 12, 35])
def test_repeats(spark, docs, empty, small_batches, window):
    rows = substrings.remove_repeats(docs, window=window).collect()
    assert len(rows) == docs.count()
    want = without_repeats([x.text for x in rows], window)
    for x, (n, gone, kept) in zip(rows, want, strict=True):
        assert (x.n_words, x.n_removed) == (n, gone), x.doc_id
        assert x.kept_text == (None if x.text is None else kept)
    if window == 35:
        assert any(0 < g < n for n, g, _ in want) and substrings.remove_repeats(empty).count() == 0


def test_covers():
    for period, cover in substrings.COVERS.items():
        assert {(a - b) % period for a in cover for b in cover} == set(range(period))


# 7


def brute_classes(texts, threshold=0.8):
    sets = {}
    for t in set(texts) - {None}:
        w = WORD.findall(t.lower())
        sets[t] = {tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))} if w else set()
    parent = {t: t for t in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    links = collections.Counter()
    keys = sorted(sets)
    for i, a in enumerate(keys):
        for b in keys[i + 1 :]:
            if sets[a] and sets[b] and len(sets[a] & sets[b]) >= threshold * len(sets[a] | sets[b]):
                links[a] += 1
                links[b] += 1
                parent[find(a)] = find(b)
    return {t: find(t) for t in sets}, links


def test_near_duplicates(spark, docs, empty, small_batches):
    rows = neardups.near_duplicates(docs).collect()
    source = docs.collect()
    assert len(rows) == len(source)
    root, links = brute_classes([x.text for x in source])
    first, copies = {}, collections.Counter(x.text for x in source)
    for x in source:
        if x.text is not None and x.doc_id is not None:
            first[root[x.text]] = min(first.get(root[x.text], x.doc_id), x.doc_id)
    want = collections.Counter((x.doc_id, first.get(root[x.text]) if x.text is not None else x.doc_id, links[x.text] if x.text is not None else 0, copies[x.text] if x.text is not None else 1) for x in source)
    assert collections.Counter((x.doc_id, x.class_id, x.n_links, x.n_copies) for x in rows) == want
    assert sum(links.values()) > 0 and neardups.near_duplicates(empty).count() == 0
    kept = neardups.keep_one_of_each(docs).collect()
    texts = [x.text for x in kept if x.text is not None]
    assert len({root[t] for t in texts}) == len(texts) and {root[t] for t in texts} == set(root.values())
    assert sum(x.text is None for x in kept) == sum(x.text is None for x in source)


def test_recall_and_prefix():
    x = neardups.prefix_length(16, 6, 0.8, 0.999)
    assert 1 - (1 - 0.8**x) ** 16 >= 0.999 > 1 - (1 - 0.8 ** (x + 1)) ** 16


@pytest.mark.parametrize("split", [None, 6])
def test_counts_of_links(split):
    r = np.random.default_rng(3)
    base = r.integers(0, 10**6, 40).astype(np.uint64)
    sets = [np.unique(np.concatenate([base[r.random(40) < 0.93], r.integers(0, 10**6, 2).astype(np.uint64)])) for _ in range(14)] + [np.array([5], np.uint64)]
    links, edges = neardups.similar_counts(sets, 0.8, split)
    pairs = [(i, j) for i in range(15) for j in range(i + 1, 15) if (split is None or i < split <= j) and len(np.intersect1d(sets[i], sets[j])) >= 0.8 * len(np.union1d(sets[i], sets[j]))]
    assert links.tolist() == [sum(k in p for p in pairs) for k in range(15)] and len(pairs) > 5


def test_chain_in_blocks(spark, small_batches):
    """A chain of texts, each like the next only, in one component of many blocks; beside it a group that is like throughout."""
    r = np.random.default_rng(11)
    stream = ["".join(map(chr, r.integers(97, 123, 6))) for _ in range(400)]
    texts = [" ".join(stream[6 * k : 6 * k + 100]) for k in range(40)] + [" ".join(stream[250:330] + [f"end{k}"]) for k in range(12)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    root, links = brute_classes(texts)
    rows = neardups.near_duplicates(df).collect()
    assert {x.doc_id: x.n_links for x in rows} == {k: links[t] for k, t in enumerate(texts)} and max(links.values()) >= 11
    first = {}
    for k, t in enumerate(texts):
        first.setdefault(root[t], k)
    assert {x.doc_id: x.class_id for x in rows} == {k: first[root[t]] for k, t in enumerate(texts)}


@pytest.mark.parametrize("threshold", [0.5, 0.8, 0.95])
def test_blocks_that_meet(spark, threshold):
    """Every pair of similar sets meets in one group, and sets meet only where an element of their prefixes does."""
    r = np.random.default_rng(12)
    base = np.sort(r.integers(0, 10**6, 60))
    sets = [np.unique(np.concatenate([base[r.random(60) < p], r.integers(0, 10**6, r.integers(0, 3))])) for p in (0.99, 0.9, 0.6) for _ in range(12)] + [np.unique(r.integers(0, 10**6, 40)) for _ in range(20)]
    rows = [(b"c", k % 7, k.to_bytes(2, "big"), x.astype(np.uint64).tobytes(), x[: neardups.prefix_size(len(x), threshold)].tolist()) for k, x in enumerate(sets)]
    df = spark.createDataFrame(rows, "component binary, block int, digest binary, shingles binary, prefix array<bigint>")
    at = collections.defaultdict(set)
    for x in neardups.meeting_blocks(df).collect():
        k = int.from_bytes(x.digest, "big")
        assert x.block == k % 7 and x.block in (x.a, x.b) and k not in at[x.a, x.b]
        at[x.a, x.b].add(k)
    similar = [(i, j) for i in range(len(sets)) for j in range(i) if len(np.intersect1d(sets[i], sets[j])) >= threshold * len(np.union1d(sets[i], sets[j]))]
    assert len(similar) > 5
    for i, j in similar:
        assert sum(i in x and j in x and (a == b) == (i % 7 == j % 7) for (a, b), x in at.items()) == 1
    assert sum(map(len, at.values())) < 7 * len(sets)


# 8


def test_katz(spark, docs, empty, small_batches):
    train = F.coalesce(F.col("doc_id") % 4 != 1, F.lit(True))
    rows = lm.score_documents(docs, train).collect()
    low = lambda t: "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or "")
    source = [(low(x.text), x.doc_id is None or x.doc_id % 4 != 1) for x in docs.collect()]
    uni, bi = collections.Counter(), collections.Counter()
    for t, learns in source:
        if learns:
            seq = [*words(t), None]
            uni.update(seq)
            bi.update(zip(["<s>", *seq[:-1]], seq, strict=True))
    n, v = sum(uni.values()), len(uni)
    of = lambda c: [sum(x == r for x in c.values()) for r in range(1, 7)]
    d1, d2 = lm.discounts(of(uni)), lm.discounts(of(bi))
    disc = lambda c, d: c - lm.LARGE if c > lm.KATZ else c * d[c]
    p = {w: disc(c, d1) / n for w, c in uni.items()}
    unknown = 1 - sum(p.values())
    total, mass, low_mass = collections.Counter(), collections.Counter(), collections.Counter()
    for (h, w), c in bi.items():
        total[h] += c
        mass[h] += disc(c, d2)
        low_mass[h] += p[w]
    weight = {h: (1 - mass[h] / total[h]) / (1 - low_mass[h]) for h in total}

    def prob(h, w):
        c = bi.get((h, w), 0)
        return disc(c, d2) / total[h] if c else weight.get(h, 1.0) * p.get(w, unknown)

    for h in list(total)[:25]:  # exactly normalised over the training words and the unknown one
        assert sum(prob(h, w) for w in uni) + prob(h, object()) == pytest.approx(1.0)
    for x in rows:
        seq = [*words(low(x.text)), None]
        assert (x.n_tokens, x.n_known, x.train_tokens) == (len(seq), sum(w in uni for w in seq), n)
        assert x.base_score == pytest.approx(sum(math.log10((uni.get(w, 0) + 1) / (n + v + 1)) for w in seq))
        assert x.score == pytest.approx(sum(math.log10(prob(h, w)) for h, w in zip(["<s>", *seq[:-1]], seq, strict=True)))
    assert lm.score_documents(empty, F.lit(True)).count() == 0
    assert all(math.isfinite(x.score) for x in lm.score_documents(docs, F.lit(False)).collect())


@pytest.mark.parametrize("n", [[207344, 59772, 25017, 14274, 13493, 7080], [1579638, 246704, 51653, 21705, 18939, 7580], [100, 0, 10, 0, 3, 0]])
def test_good_turing_on_copies(n):
    """Numbers of kinds that copies lift are smoothed, so that each factor is Good and Turing's on a falling line."""
    x = np.array([r for r in range(1, 7) if n[r - 1]])
    z = np.array([2 * n[r - 1] / ((x[k + 1] if k + 1 < len(x) else 2 * r - x[k - 1]) - (x[k - 1] if k else 0)) for k, r in enumerate(x)])
    lx, lz = np.log(x), np.log(z)
    b = ((lx - lx.mean()) * (lz - lz.mean())).sum() / ((lx - lx.mean()) ** 2).sum()
    c = 6 ** (b + 1)
    d = lm.discounts(n)
    assert d[1:].tolist() == pytest.approx([((1 + 1 / r) ** (b + 1) - c) / (1 - c) for r in range(1, 6)])
    assert (0 < d[1:]).all() and (np.diff(d[1:]) > 0).all() and d[5] < 1


def test_other_discounts():
    fine = [1000, 300, 140, 80, 52, 36]  # factors between 0 and 1 as they are: taken without smoothing
    c = 6 * 36 / 1000
    assert lm.discounts(fine)[1:].tolist() == pytest.approx([((r + 1) * fine[r] / fine[r - 1] / r - c) / (1 - c) for r in range(1, 6)])
    assert lm.discounts([1, 2, 3, 4, 5, 6])[1:].tolist() == pytest.approx([(r - 0.2) / r for r in range(1, 6)])  # a rising line
    assert lm.discounts([0] * 6)[1:].tolist() == pytest.approx([(r - 0.5) / r for r in range(1, 6)])


def test_blocks_by_bytes(spark, monkeypatch):
    """Near copies of a long text, in blocks of as many sets as fit: the same classes and links as in one block."""
    r = np.random.default_rng(8)
    base = [f"w{k}" for k in r.integers(0, 500, 1200)]
    texts = []
    for k in range(24):
        words = list(base)
        for at in r.choice(len(words), k * 2, replace=False):
            words[at] = f"x{k}"
        texts.append(" ".join(words))
    df = spark.createDataFrame([(k, t) for k, t in enumerate(texts)] + [(100, texts[3]), (101, "alone in its class of five words or more")], "doc_id bigint, text string").repartition(3)
    want = sorted(map(tuple, neardups.near_duplicates(df).drop("digest").collect()))
    assert len({x[1] for x in want}) > 1 and max(x[2] for x in want) > 10
    for size in (40_000, 9_000, 1):
        monkeypatch.setattr(neardups, "BLOCK_BYTES", size)
        assert sorted(map(tuple, neardups.near_duplicates(df).drop("digest").collect())) == want


# pipeline


def test_pipeline(spark, docs, tmp_path, small_batches):
    folder = str(tmp_path / "sf")
    tables = docs.select("doc_id", "text", "lang", "source", "n_chars")
    leak = "a passage of the benchmark that was copied into one of the documents word by word and all"
    tables = tables.union(spark.createDataFrame([(9000, "und der die das ein " + leak, "de", "src3", 0)], tables.schema))
    r = np.random.default_rng(5)
    foreign = [(9100 + k, " ".join("".join(map(chr, r.integers(0x430, 0x450, r.integers(2, 9)))) for _ in range(60)), None, "src3", 0) for k in range(10)]
    tables = tables.union(spark.createDataFrame(foreign, tables.schema))
    tables.write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([(1, leak), (2, None)], "item_id bigint, text string").write.parquet(f"{folder}/benchmark.parquet")
    now = spark.read.parquet(f"{folder}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, now, folder)
        out.write.parquet(str(tmp_path / name))
        after = spark.read.parquet(str(tmp_path / name))
        a, b = now.collect(), after.collect()
        if name != "mix":
            assert after.columns == now.columns
        if name == "language_id":
            left, odd = collections.Counter(map(repr, b)), lambda x: x.doc_id is None or 3000 <= x.doc_id < 9000
            assert left <= collections.Counter(repr(x) for x in a if x.text and any(c.isalpha() for c in x.text))
            assert collections.Counter(repr(x) for x in b if not odd(x)) == collections.Counter(repr(x) for x in a if not odd(x) and not 9100 <= x.doc_id < 9200)
            assert not any(9100 <= (x.doc_id or 0) < 9200 for x in b)  # an unlearned script
        if name == "near_duplicates":
            root, _ = brute_classes([x.text for x in a])
            assert len(b) == len(set(root.values())) == len({root[x.text] for x in b})
        if name == "substring_dedup":
            want = {x.doc_id: (x.text if not gone else kept) for x, (n, gone, kept) in zip(a, without_repeats([x.text for x in a], 35), strict=True) if gone < n or not n}
            assert {x.doc_id: x.text for x in b} == want
        if name == "decontaminate":
            assert {x.doc_id for x in a} - {x.doc_id for x in b} == {9000}
        if name == "mix":
            assert len(b) == len(a) and all(x.taken <= 2 * x.size for x in b)
        now = after
    assert collections.Counter(map(repr, corpus_pipeline.run(spark, folder).collect())) == collections.Counter(map(repr, b))


def test_pipeline_keeps_columns_of_any_name(spark, docs, empty, tmp_path, small_batches):
    """Columns named like those an operator makes, and with dots and backticks, come out as they went in."""
    folder = str(tmp_path / "sf")
    names = ("score", "lang_pred", "n_words", "n_removed", "kept_text", "matches", "a.b", "c`d", "_rest", "_digest", "_key", "Held_out", "digest")
    wide = docs.select("doc_id", "text", "lang", "source", "n_chars")
    for k, name in enumerate(names):
        wide = wide.withColumn(name, F.concat(F.lit(f"mine {k} "), F.coalesce(F.col("doc_id").cast("string"), F.lit("-"))))
    wide = wide.withColumn("tags", F.array("doc_id"))
    spark.createDataFrame([(1, "no document has this passage, whatever it may say of anything at all"), (2, None)], "item_id bigint, text string").write.parquet(f"{folder}/benchmark.parquet")
    for source in (wide, wide.limit(0), wide.limit(20).union(wide.limit(20))):
        now = source
        for name, stage in corpus_pipeline.STAGES[:-1]:
            out = stage(spark, now, folder)
            assert out.columns == now.columns and [t.lower() for _, t in out.dtypes] == [t.lower() for _, t in now.dtypes]
            path = str(tmp_path / f"{name}{np.random.randint(1 << 40)}")
            out.write.parquet(path)
            now = spark.read.parquet(path)
            for x in now.collect():
                assert [x[n] for n in names] == [f"mine {k} {'-' if x.doc_id is None else x.doc_id}" for k in range(len(names))] and x.tags == [x.doc_id]
        assert corpus_pipeline.STAGES[-1][1](spark, now, folder).count() == now.count()
        assert now.count() > 0 or source.count() == 0


def test_language_bound_is_smooth(spark):
    rows = spark.range(1, 3000).select(corpus_pipeline.least_score(F.repeat(F.lit("x"), F.col("id").cast("int"))).alias("b")).collect()
    bounds = [x.b for x in rows]
    assert all(0 < b - a < 0.01 for a, b in zip(bounds, bounds[1:], strict=False)) and bounds[-1] < corpus_pipeline.LEAST_SCORE
