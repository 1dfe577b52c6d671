"""Exact top-k search, periodic runs and the Merkle manifest against brute force."""

import hashlib
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from nightloom.llm import merkle, periods, topk

# 11


def vectors(kind, n=300, width=12, seed=3):
    r = random.Random(seed)
    rows = []
    for k in range(n):
        if kind == "ties":
            v = [r.choice([-0.5, 0.0, 0.5]) for _ in range(width)]
        elif kind == "clustered":
            v = [r.gauss(0, 0.05) + (1.0 if (k % 6) == d else 0.0) for d in range(width)]
        else:
            v = [r.gauss(0, 0.3) for _ in range(width)]
        rows.append([k, v, "label"])
    return rows


def best_by_scan(rows, k, divisor, scale=256):
    width = max((len(v) for _, v, _ in rows if v), default=0)
    good = []
    for i, v, _ in rows:
        if v is not None and all(x is not None and np.isfinite(x) for x in v):
            good.append((i, [int(np.floor(x * scale)) for x in v] + [0] * (width - len(v))))
    out = []
    for a, (i, q) in enumerate(good):
        if i is not None and i % divisor == 0:
            scored = sorted((-sum(x * y for x, y in zip(q, v, strict=True)), j is None, j or 0, b) for b, (j, v) in enumerate(good) if b != a)
            out += [(i, rank, None if no else j, -s) for rank, (s, no, j, _) in enumerate(scored[:k], 1)]
    return out


@pytest.mark.parametrize("kind", ["random", "ties", "clustered"])
def test_top_matches_as_by_a_scan(spark, kind):
    rows = vectors(kind)
    rows += [[7, rows[7][1], "again"], [10, rows[20][1], "same id"], [None, rows[10][1], "no id"], [1000, None, "x"], [1010, [1.0, None] + [0.0] * 10, "x"], [1020, [float("nan")] * 12, "x"], [1030, [float("inf")] * 12, "x"], [1040, [0.0] * 12, "x"], [1050, [0.5, -0.5], "short"], [1060, [], "none"]]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>, v string").withColumns({"score": F.lit("s"), "rank": F.lit(1), "query_id": F.lit(2), "_query": F.lit(3), "row": F.lit(4), "block": F.lit(5)}).repartition(4)
    for block, per in ((16384, 1024), (37, 5)):
        got = topk.top_matches(df, F.col("vec_id") % 10 == 0, block_rows=block, query_rows=per)
        assert got.columns == ["query_id", "rank", "vec_id", "score"]
        assert sorted(map(repr, map(tuple, got.collect()))) == sorted(map(repr, best_by_scan(rows, 5, 10)))


def test_few_candidates_and_none(spark):
    few = spark.createDataFrame(vectors("random", 3), "vec_id bigint, embedding array<double>, v string")
    assert sorted(map(tuple, topk.top_matches(few, F.col("vec_id") % 2 == 0).select("query_id", "rank").collect())) == [(0, 1), (0, 2), (2, 1), (2, 2)]
    assert topk.top_matches(few.limit(0), F.col("vec_id") % 2 == 0).count() == 0
    assert topk.top_matches(few, F.lit(False)).count() == 0
    assert topk.top_matches(few.limit(1), F.lit(True)).count() == 0


def test_reading_stops_before_the_end():
    """Where the best rows stand out the lists are read a little way; where nothing does, to the end, with the same result."""
    r = np.random.default_rng(5)
    v = r.integers(-60, 60, (4000, 8))
    v[:10] = 250
    lists = topk.SortedLists(np.arange(4000), np.arange(4000), v)
    places, scores, looked = lists.top(np.full(8, 200), 5, 0)
    assert looked < 1500 and places.tolist() == [1, 2, 3, 4, 5] and set(scores.tolist()) == {200 * 250 * 8}
    places, scores, looked = lists.top(np.zeros(8, int), 3, 1)
    assert places.tolist() == [0, 2, 3] and not scores.any()


def test_large_components_stay_exact():
    v = np.array([[1 << 24, -(1 << 24), 1], [1 << 24, -(1 << 24), 2], [3, 4, 5]])
    assert topk.SortedLists(np.arange(3), np.arange(3), v).top(v[0], 2, None)[1].tolist() == [(1 << 49) + 2, (1 << 49) + 1]


# 12


def runs_by_hand(ws, least=24, times=3):
    n, out = len(ws), {}
    for q in range(1, n // times + 1):
        i = 0
        while i < n - q:
            if ws[i] != ws[i + q]:
                i += 1
                continue
            j = i
            while j < n - q and ws[j] == ws[j + q]:
                j += 1
            if j - i + q >= max(least, times * q):
                out.setdefault((i, j - i + q), q)
            i = j
    return sorted((s, m, q) for (s, m), q in out.items())


def periodic_texts(seed=1, n=150):
    r = random.Random(seed)
    texts = []
    for k in range(n):
        ws, size = [], (0, 5, 30, 200, 700)[k % 5]
        while len(ws) < size:
            kind = r.random()
            if kind < 0.4:
                ws += [r.choice("abcdefgh"[: r.randint(1, 8)]) for _ in range(r.randint(1, 40))]
            elif kind < 0.8:
                ws += ([r.choice("abcdefghij") for _ in range(r.choice([1, 2, 3, 5, 8, 13, 40, 60]))] * r.randint(2, 9))[: r.randint(1, 300)]
            else:
                ws += ws[r.randrange(len(ws)) :] * r.randint(1, 4) if ws else ["z"]
        texts.append(r.choice([" ", "\n", " \t"]).join(ws[:1200]))
    fibonacci = ["a", "b"]
    while len(fibonacci[-1]) < 900:
        fibonacci.append(fibonacci[-1] + fibonacci[-2])
    return texts + [None, "", " \n\t ", "one", "a " * 1500, "x y z " * 200 + "x", "  " * 30, "é b " * 24, " ".join(fibonacci[-1]), " ".join("ab" * 11), " ".join("ab" * 12), " ".join("a" * 23), " ".join("a" * 24)]


def test_cover_meets_every_difference():
    assert {(b - a) % periods.PERIOD for a in periods.COVER for b in periods.COVER} == set(range(periods.PERIOD))


def test_common_extensions():
    r = random.Random(8)
    w = np.array([r.choice([0, 0, 0, 1]) for _ in range(700)] + [0] * 200 + [1] + [0] * 200 + [-1], np.int32)
    i, j = (np.array(x) for x in zip(*[sorted(r.sample(range(len(w)), 2)) for _ in range(3000)], strict=True))
    want = []
    for a, b in zip(i, j, strict=True):
        n = 0
        while b + n < len(w) and w[a + n] == w[b + n]:
            n += 1
        want.append(n)
    assert periods.CommonExtensions(w).ask(i, j).tolist() == want


@pytest.mark.parametrize("words, pairs", [(1 << 18, 1 << 19), (300, 500)])
def test_runs_as_by_hand(monkeypatch, words, pairs):
    monkeypatch.setattr(periods, "CHUNK_WORDS", words)
    monkeypatch.setattr(periods, "CHUNK_PAIRS", pairs)
    texts = periodic_texts()
    for least, times in ((24, 3), (8, 2)):
        found, counts, kept = periods.runs_of(texts, least, times)
        n_runs = 0
        for t, runs, n, rest in zip(texts, found, counts, kept, strict=True):
            ws = (t or "").encode().split()
            want = runs_by_hand(ws, least, times)
            gone = {i for s, m, q in want for i in range(s + q, s + m)}
            assert [(x["start"], x["length"], x["period"]) for x in runs] == want and n == len(ws)
            assert rest.encode() == b" ".join(x for i, x in enumerate(ws) if i not in gone)
            n_runs += len(want)
        assert n_runs > 100


def test_runs_in_a_table(spark, docs, empty):
    out = periods.find_runs(docs.withColumn("runs", F.lit("old")))
    assert out.count() == docs.count() and set(docs.columns) <= set(out.columns)
    assert all(x.kept_text == " ".join((x.text or "").encode().split() and [w.decode() for w in (x.text or "").encode().split()]) for x in out.filter(F.size("runs") == 0).collect())
    assert periods.find_runs(empty).count() == 0


def test_looped_texts_and_digests(spark, docs, monkeypatch):
    from nightloom.llm import queries

    monkeypatch.setattr(periods, "table", lambda spark, sf_dir, name: docs)
    texts = {}
    for x in docs.collect():
        texts.setdefault(x.doc_id, set()).add(x.text)
    got = queries.queries()["op12_periodic_runs"](spark, "").collect()
    assert len(got) == docs.count()
    ended = 0
    for x in got:
        wants = []
        for t in texts[x.doc_id]:
            ws = [w.decode() for w in (t or "").encode().split()]
            n, h = len(ws), None if x.doc_id is None else zlib.crc32(str(x.doc_id).encode())
            if h is not None and h % 10 == 0 and n:
                g = h // 10
                a = g % n
                p = 1 + (n - a) // (3 + g % 8)
                ws = [ws[i] if i < a else ws[a + (i - a) % p] for i in range(n)]
                ended += 1
            runs = runs_by_hand(ws)
            gone = {i for s, m, q in runs for i in range(s + q, s + m)}
            best = max(runs, key=lambda r: (r[1] / r[2], -r[0], -r[2])) if runs else (None,) * 3
            digest = lambda s: hashlib.sha256(s.encode()).hexdigest()
            wants.append((len(runs), *best, 1000 * best[1] // best[2] if runs else None, digest("".join(f"{s},{m},{q}\n" for s, m, q in runs)), digest(" ".join(w for i, w in enumerate(ws) if i not in gone))))
        assert tuple(x)[1:] in wants
    assert ended > 5


# 13


def tree_by_hand(hashes):
    """(root, per leaf the list of (left, right) up to it)."""
    digest = lambda s: hashlib.sha256(s.encode()).hexdigest()
    paths, where = [[] for _ in hashes], list(range(len(hashes)))
    while len(hashes) > 1:
        runs = [hashes[k : k + 8] for k in range(0, len(hashes), 8)]
        for leaf, at in enumerate(where):
            run = runs[at // 8]
            paths[leaf].append(("".join(run[: at % 8]), "".join(run[at % 8 + 1 :])))
        where, hashes = [at // 8 for at in where], [digest("".join(run)) for run in runs]
    return hashes[0], paths


def frames(*values):
    return "".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values)


@pytest.mark.parametrize("sizes", [{"en": 1}, {"en": 700, "de": 9, None: 8, "": 1, "é": 65}, {f"l{k:03}": 1 + k % 3 for k in range(70)}])
def test_manifest_by_hand(spark, sizes):
    r = random.Random(2)
    rows = []
    for lang, n in sizes.items():
        rows += [(len(rows) * 7 % 100003 + k, r.choice([None, "Some TEXT", "", "Ü" * 3, f"word {k}"]), lang, r.choice(["s", None]), r.choice([None, k])) for k in range(n)]
    if len(rows) > 3:
        rows += [rows[0], rows[1], (None, "No Id", rows[2][2], "s", 1), (None, None, None, None, None)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint").withColumns({"key": F.lit("k"), "pos": F.lit(1), "n": F.lit(1), "h": F.lit("h"), "o": F.lit(1), "row": F.lit(1)}).repartition(3)
    digest = lambda s: hashlib.sha256(s.encode()).hexdigest()
    low = lambda t: None if t is None else "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t)
    groups = {}
    for d, t, lang, s, n in rows:
        leaf = digest(frames(d, s, lang, n, t))
        now = digest(frames(d, s, lang, n, low(t))) if d is not None and zlib.crc32(str(d).encode()) % 3 == 0 else leaf
        groups.setdefault(lang, []).append((d is not None, d or 0, leaf, now))
    order = sorted(groups, key=lambda x: (x is not None, (x or "").encode()))
    trees = {g: tree_by_hand([x[2] for x in sorted(groups[g])]) for g in order}
    root, tops = tree_by_hand([trees[g][0] for g in order])
    want = []
    for g, top in zip(order, tops, strict=True):
        for (has, d, leaf, now), path in zip(sorted(groups[g]), trees[g][1], strict=True):
            h = now
            for left, right in path + top:
                h = digest(left + h + right)
            want.append((d if has else None, leaf, trees[g][0], root, digest("".join(a + b for a, b in path + top)), h, h == root))
    merkle_table, merkle.table = merkle.table, lambda spark, sf_dir, name: df
    try:
        got = [tuple(x) for x in merkle.op13_merkle_manifest(spark, "").collect()]
    finally:
        merkle.table = merkle_table
    assert sorted(map(repr, got)) == sorted(map(repr, want))
    if len(rows) > 100:
        assert any(not x[-1] for x in got) and any(x[-1] for x in got)


def test_manifest_of_an_empty_table(spark, empty):
    assert merkle.merkle_manifest(empty, merkle.row_hash(F.col("doc_id"), F.col("text"))).count() == 0


def test_framing_tells_values_apart(spark):
    values = [("1:a", None), ("1", ":a"), (None, "1:a"), ("", "-"), ("-", ""), (None, None)]
    df = spark.createDataFrame(values, "a string, b string").select(merkle.row_hash(F.col("a"), F.col("b")).alias("h"))
    assert df.distinct().count() == len(values)
