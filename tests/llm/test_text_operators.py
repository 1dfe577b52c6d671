"""Decontamination, language ID, URL rules, HTML, audio and token counts against brute force on small tables."""

import hashlib
import random
import time
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from nightloom.llm import audio, decontaminate, htmltext, langid, lm, neardups, substrings, tokens, urls


def same_rows(df, out, new):
    """All rows and all other columns are still there."""
    assert out.count() == df.count() and set(df.columns) - set(new) <= set(out.columns)


# 1


def edits(a, b):
    row = list(range(len(b) + 1))
    row = [0] * (len(b) + 1)
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j - 1] + (x != y), row[j] + 1, new[-1] + 1))
        row = new
    return min(row)


def test_benchmark_found_as_by_brute_force(spark, docs, empty):
    r = random.Random(4)
    items = [(k, " ".join("".join(r.choice("abcdefgh") for _ in range(r.randint(2, 7))) for _ in range(25))) for k in range(12)] + [(50, None), (None, "x" * 60), (51, "The capital of Peru is: Lima!"), (52, ""), (53, "Lima"), (54, "ima"), (55, " . ")]
    rows = []
    for k in range(40):
        item = items[k % 12][1]
        cut = item if k % 3 else item[: len(item) // 2 + 45]
        text = list(cut)
        for _ in range(k % 5):
            text[r.randrange(len(text))] = r.choice("xyz")
        rows.append((k, "Some words before, " + "".join(text).upper() + " and after that"))
    rows += [(300 + k, t) for k, t in enumerate(["the CAPITAL of peru is lima", "so: the capital of peru is (lima) now", "the capital of peru is limaa", "lima", "lima, lima", "xlima", "the capital of  Peru\nis lima", items[0][1][7:87]])]
    rows += [(100 + k, " ".join(r.choice(items[:12])[1].split()[:4]) + " other text") for k in range(10)] + [(200, None), (201, ""), (None, items[0][1])]
    table = spark.createDataFrame(rows, "doc_id bigint, text string").withColumn("matches", F.lit("old"))
    bench = spark.createDataFrame(items, "item_id bigint, text string")
    found = {(x.doc_id, x.text): {m.item for m in x.matches} for x in decontaminate.find_benchmark(table, bench).collect()}
    norm = lambda t: "".join(map(chr, decontaminate.normal(t)))
    for (doc, text), got in found.items():
        want = set()
        for item, raw in items:
            if item is None or not norm(raw):
                continue
            if len(norm(raw)) < 40:
                if f" {norm(raw)} " in f" {norm(text)} ":
                    want.add(item)
            elif any(edits(norm(raw)[a:b], norm(text)) <= int(0.06 * (b - a)) for a, b in decontaminate.windows_of(len(norm(raw)), 60, 20)):
                want.add(item)
        assert got == want, doc
    assert found[300, "the CAPITAL of peru is lima"] == {51, 53} and 0 in found[307, items[0][1][7:87]]
    same_rows(docs, decontaminate.find_benchmark(docs, bench), ["matches"])
    assert decontaminate.find_benchmark(empty, bench).count() == 0
    assert decontaminate.find_benchmark(docs, bench.limit(0)).filter("size(matches) > 0").count() == 0


def test_several_blocks(spark, docs, monkeypatch):
    bench = spark.createDataFrame([(k, x.text[:200]) for k, x in enumerate(docs.filter("length(text) > 300 and doc_id < 20").collect())], "item_id bigint, text string")
    bench = bench.union(spark.createDataFrame([(900, "日本語 テキスト"), (901, "x" * 3000)], bench.schema))
    answer = lambda: sorted(repr(x) for x in decontaminate.find_benchmark(docs, bench).collect())
    whole = answer()
    monkeypatch.setattr(decontaminate, "BLOCK_CHARS", 1500)  # less than the longest item
    assert answer() == whole and sum("item=901" in x for x in whole) == 1


def test_no_name_clashes(spark):
    """Columns of any name, those used at work included, pass through as they were."""
    names = ["_d", "_id", "_digest", "_best", "_blocks", "_article", "_read", "_text", "_found", "_url", "_words", "_gone", "_kept", "_first", "_class", "_Short", "t", "i", "bucket"]
    rows = [(k, "word " * (k + 1), "http://a.net/x", f"<p>one two three {k}</p>", *[f"{n}{k}" for n in names]) for k in range(4)] + [(9, None, None, None, *[None] * len(names))]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, url string, html string, " + ", ".join(f"`{n}` string" for n in names))
    bench = spark.createDataFrame([(1, "word word word word")], "item_id bigint, text string")
    outs = [
        decontaminate.find_benchmark(df, bench), langid.identify_language(df, langid.train_prototypes(df.withColumn("lang", F.lit("x")))), urls.judge_urls(df, urls.url_rules(spark, urls.CONTRACT_RULES)), htmltext.extract_text(df, column="main"),
        substrings.remove_repeats(df), neardups.keep_one_of_each(df), lm.score_documents(df, F.lit(True)), audio.store_as_audio(df), tokens_or_none(df),
    ]
    for out in filter(None, outs):
        assert sorted(repr(x) for x in out.select("doc_id", *names).collect()) == sorted(repr(x) for x in df.select("doc_id", *names).collect())


def tokens_or_none(df):
    try:
        import public_tokenizers
    except ImportError:
        return None
    return tokens.count_tokens(df, public_tokenizers.path("byte_bpe_50k.json"))


# 2


def test_language(spark, docs, empty):
    held = F.coalesce(F.col("doc_id") % 3 == 0, F.lit(False))
    prototypes = langid.train_prototypes(docs.filter(~held))
    out = langid.identify_language(docs, prototypes)
    same_rows(docs, out, ["lang_pred", "score"])
    rows = out.collect()
    tried = [x for x in rows if x.doc_id is not None and x.doc_id < 1000 and x.doc_id % 3 == 0 and len(x.text) > 100]
    assert sum(x.lang_pred == x.lang for x in tried) >= 0.97 * len(tried)
    assert all(x.lang_pred == "und" and x.score == 0 for x in rows if x.text is None or not any(c.isalpha() for c in x.text))
    assert all(0 <= x.score <= 1 and x.lang_pred in ("en", "de", "und") for x in rows)
    assert langid.identify_language(empty, prototypes).count() == 0
    assert {x.lang_pred for x in langid.identify_language(docs, langid.train_prototypes(empty)).collect()} == {"und"}


def test_language_by_brute_force(spark, docs):
    """Vectors put together letter by letter and trigram by trigram, in Python numbers."""
    dim = 128
    letter = lambda c: np.random.default_rng([11, ord(c) if c.isalpha() else 32]).integers(0, 2, dim) * 2 - 1

    def vector(text):
        runs = "".join(c if c.isalpha() else " " for c in (text or "").lower())
        runs = " " + " ".join(runs.split()) + " "
        if not runs.strip():
            return None
        runs += " " if not (text or "").lower()[-1].isalpha() else ""  # the boundary behind the last letter, and the end
        total = np.zeros(dim)
        for a, b, c in zip(runs, runs[1:], runs[2:], strict=False):
            total += np.roll(letter(a), 2) * np.roll(letter(b), 1) * letter(c)
        return total / np.sqrt((total**2).sum())

    some = docs.filter("doc_id < 12 or doc_id >= 3005 or doc_id is null")
    rows = some.collect()
    sums = {}
    for x in rows:
        if x.lang and (v := vector(x.text)) is not None:
            sums[x.lang] = sums.get(x.lang, 0) + v
    got = langid.identify_language(some, langid.train_prototypes(some, dimensions=dim)).collect()
    for x in got:
        v = vector(x.text)
        cosines = {k: float(v @ s / np.sqrt((s**2).sum())) for k, s in sums.items()} if v is not None else {}
        assert x.score == pytest.approx(max([0.0, *cosines.values()]), abs=2e-5), x.text
        assert x.lang_pred == (max(sorted(cosines), key=cosines.get) if cosines else "und") or x.score < 1e-4


def test_many_languages(spark, docs, monkeypatch):
    """More labels than a task holds: the best of all blocks."""
    prototypes = langid.train_prototypes(docs.withColumn("lang", F.concat("lang", (F.col("doc_id") % 7).cast("string"))))
    key = lambda out: {(x.doc_id, x.text): (x.lang_pred, x.score) for x in out.collect()}
    whole = key(langid.identify_language(docs, prototypes))
    monkeypatch.setattr(langid, "BLOCK_LABELS", 3)
    for k, (lang, score) in key(langid.identify_language(docs, prototypes)).items():
        assert score == pytest.approx(whole[k][1], abs=2e-6) and (lang == whole[k][0] or score < 0.02)
    assert len({lang for lang, _ in whole.values()}) > 5


def test_vectors_do_not_hang_on_what_came_before(monkeypatch):
    monkeypatch.setattr(langid, "MOST_LETTERS", 20)
    a, b = langid.Encoder(256, 3, cached=50), langid.Encoder(256, 3)
    for t in ("zz yy xx", "日本語", "Ärger", "q" * 300, "abc def " * 40, "".join(map(chr, range(0x4E00, 0x4E40)))):
        a.vector(t)
    for t in ("the cat sat", "日本 語 abc", "a"):
        assert np.allclose(a.vector(t), b.vector(t), atol=1e-6)


# 3

URLS = [None, "", "no scheme", "http://", "https://a.EXAMPLE.net/en/x?y#z", "http://example.net/en", "http://example.net/en/", "http://net/", "http://xnet/", "http://a.example.com/de/1", "http://a.example.org/fr/", "ftp://x.org/fr", "http://a.net?q=/en/", "http://a.net", "a://b.c://d", "http://NET/de/", "http://u@example.com:80/de/", "http://ÄÖ.net/", "http://a..net/", "http://net./", "http://a.net/#/en/"] * 2


def judged(url, rules):
    host = path = ""
    if url and "://" in url:
        rest = url.split("://", 1)[1]
        host = rest
        for c in "/?#":
            host = host.split(c)[0]
        path = rest[len(host) :].split("?")[0].split("#")[0]
        host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in host)
    fits = [(len(h + p), len(h), a == "block", h + p, a) for a, h, p in rules if host and (host == h or host.endswith("." + h)) and path.startswith(p)]
    best = max(fits, default=None)
    return host, path, best and best[3], best[4] if best else "allow"


def test_long_hosts(spark):
    """A host of very many labels costs what its length is."""
    long = "a." * 20_000
    df = spark.createDataFrame([(1, f"http://{long}net/x"), (2, f"http://{long}example.net/en/"), (3, f"http://{long}org/")], "page_id int, url string")
    began = time.time()
    assert {x.page_id: (x.rule, x.verdict) for x in urls.judge_urls(df, urls.url_rules(spark, urls.CONTRACT_RULES)).collect()} == {1: ("net/", "block"), 2: ("example.net/en/", "allow"), 3: (None, "allow")}
    assert time.time() - began < 20


@pytest.mark.parametrize("rules, limit", [(urls.CONTRACT_RULES, 1 << 20), (urls.CONTRACT_RULES + [("allow", "net", "/de/"), ("block", "a.example.org", ""), ("allow", "a.example.org", "")], 0), ([], 10)])
def test_urls(spark, rules, limit):
    df = spark.createDataFrame([(k, u, "old") for k, u in enumerate(URLS)], "page_id int, url string, verdict string")
    out = urls.judge_urls(df, urls.url_rules(spark, rules), broadcast_bytes=limit)
    got = {x.page_id: (x.host, x.path, x.rule, x.verdict) for x in out.collect()}
    assert got == {k: judged(u, rules) for k, u in enumerate(URLS)}
    assert urls.judge_urls(df.limit(0), urls.url_rules(spark, rules)).count() == 0


# 4

PAGES = [
    ("<html><head><title>No</title><style>p{}</style></head><body><nav><a href=1>Menu</a></nav><article><h1>Head</h1><p>One  two\n three &amp; four.</p><script>var x='</p>'</script><p>Short.</p></article><footer>Foot</footer></body>", "Head\nOne two three & four.\nShort."),
    ("<header>Site name</header><div class='ad-box'>Buy this thing now</div><main><article><p>Text <b>bold</b>er <a href='x'>link words</a> and more words.<aside>Side note here</aside><form>Your name <input></form><div id=comments><p>I like it very much indeed</p></div><!-- x --></article></main>", "Text bolder link words and more words."),
    ("<article><p>a<p>b<ul><li>c</li></ul><div class=\"newsletter signup\">Sign up</div></article>", "a\nb\nc"),
    ("<article><p title=\"1 > 0\">x &lt;p&gt; &#233;&nbsp;y</p></article>", "x <p> é y"),
    ("<div class=ad>unclosed advert<article><p>kept</p></article>", "kept"),
    ("<article><p title='unclosed>kept</p><p class=\"x\">too</p></article>", "kept\ntoo"), ("<article><!--><p>kept</p><!-- gone --!><p>too</p><!-- rest", "kept\ntoo"), ("<article><p>1 < 2 <3 kept", "1 < 2 <3 kept"),
    (None, ""), ("", ""), ("<nav>a</nav>", ""), ("<article></article>", ""),
]


def test_pages(spark):
    df = spark.createDataFrame([(k, h, "old") for k, (h, _) in enumerate(PAGES)] * 2, "page_id int, html string, text string")
    out = htmltext.extract_text(df)
    rows = out.collect()
    assert len(rows) == 2 * len(PAGES)
    for x in rows:
        assert x.text == PAGES[x.page_id][1], x.page_id
    assert htmltext.extract_text(df.limit(0)).count() == 0


def decided(tree, row):
    while isinstance(tree, tuple):
        tree = tree[2] if row[tree[0]] <= tree[1] else tree[3]
    return tree >= 0.5


def test_tree_keeps_its_table_and_finds_held_out_blocks():
    """All labelled blocks by a tree of all pages; nine in ten of each third of the pages by a tree of the others."""
    rows = htmltext.labelled_blocks()
    tree = htmltext.grow_tree(rows)
    used = set()

    def names(t):
        if isinstance(t, tuple):
            used.add(htmltext.FEATURES[t[0]])
            names(t[2])
            names(t[3])

    names(tree)
    assert all(decided(tree, r) == bool(r[-1]) for r in rows)
    assert used & {"prev_words", "next_words"} and used & {"prev_density", "next_density"}  # neighbours decide
    right = total = 0
    for k in range(3):
        others, own = ([p for i, p in enumerate(htmltext.LABELLED_PAGES) if (i % 3 == k) == held] for held in (False, True))
        learned, tried = htmltext.grow_tree(htmltext.labelled_blocks(others)), htmltext.labelled_blocks(own)
        right, total = right + sum(decided(learned, r) == bool(r[-1]) for r in tried), total + len(tried)
    assert right >= 0.9 * total


def test_no_tag_or_name_loses_an_article(spark):
    r = random.Random(17)
    w = lambda n: words(r, n)
    p60, p400 = w(60), w(400)
    whole = {
        "teaser": (f"<div id=content>{p400}</div><article><a href=x>{w(8)}</a></article>", p400),
        "related": (f"<article class='post related'><p>{p60}</p><p>{p400}</p></article>", f"{p60}\n{p400}"),
        "search": (f"<article id=search><p>{p400}</p></article>", p400), "share": (f"<article class='share'><p>{p400}</p></article>", p400), "reply": (f"<article class='reply'><p>{p400}</p></article>", p400),
        "sidebar page": (f"<div class='page with sidebar'><p>{p60}</p><p>{p400}</p></div>", f"{p60}\n{p400}"), "layout": (f"<div class='sidebar-layout'><h1>Peru</h1><p>{p400}</p></div>", f"Peru\n{p400}"),
        "modal": (f"<div id=modal-root class='nav-fixed'><p>{p60}</p><p>{p400}</p></div>", f"{p60}\n{p400}"), "form": (f"<form action=x><h1>Peru</h1><p>{p400}</p></form>", f"Peru\n{p400}"),
        "headings": (f"<h1>Peru</h1><p>{p60}</p><h2>History</h2><p>one two three four five six seven eight nine</p><h2>Climate</h2><p>{p60}</p>", f"Peru\n{p60}\nHistory\none two three four five six seven eight nine\nClimate\n{p60}"),
        "references": (f"<article><p>{p60}</p><ul><li><a href=a>{p60[:60]}</a><li><a href=b>{p60[:80]}</a></ul><p><a href=c>{p60[:70]}</a></p></article>", "\n".join(" ".join(x.split()) for x in (p60, p60[:60], p60[:80], p60[:70]))),
        "copyright": (f"<p>{p60}</p><p>{p400}</p><p>© 2020 Acme Ltd, all rights reserved</p>", f"{p60}\n{p400}"),
        "comments": (f"<article><p>{p60}</p></article><div class=comments><article class=comment><p>{p400}</p></article></div>", p60),
        "math": (f"<article><p>{p60} <math><mi>x</mi><annotation>tex</annotation></math></p></article>", f"{p60} x"),
    }
    df = spark.createDataFrame([(k, h) for k, (h, _) in whole.items()], "page_id string, html string")
    got = {x.page_id: x.text for x in htmltext.extract_text(df).collect()}
    assert {k: got[k] for k in whole} == {k: t for k, (_, t) in whole.items()}


def words(r, n):
    return " ".join("".join(r.choice("abcdefghij") for _ in range(r.randint(1, 9))) for _ in range(n))


def test_articles_are_kept_whole(spark):
    """Articles of any paragraph lengths, some with names that sound like an aside, against what they were made of."""
    r = random.Random(7)
    rows, want = [], {}
    for k in range(150):
        parts = [words(r, r.choice([1, 2, 5, 30, 90, 400])) for _ in range(r.randint(1, 9))]
        name = r.choice(["", " class='share-price'", " id=related-work", " class='post navigation-history'"])
        body = "".join(f"<{t}>{p}</{t}>" for p, t in zip(parts, ["h1", *["p"] * 9], strict=False))
        noise = lambda: r.choice(["", f"<nav><ul><li><a href=x>{words(r, 1)}</a><li><a href=y>{words(r, 3)}</a></ul></nav>", f"<div class='ad'>{words(r, 25)}</div>", f"<footer>{words(r, 12)}</footer>", f"<div class='cookie-notice'><p>{words(r, 60)}</p></div>"])
        rows.append((k, f"<html><head><title>{words(r, 4)}</title></head><body>{noise()}{noise()}<article{name}>{body}</article>{noise()}</body></html>"))
        want[k] = "\n".join(parts)
    rows.append((900, "<article class='share-price'>" + words(r, 60) + "</article>"))
    inner = words(r, 60)
    rows.append((901, f"<article><p>{words(r, 50)}</p><div class='related-work'><p>{inner}</p></div><p>{words(r, 40)}</p></article>"))
    got = {x.page_id: x.text for x in htmltext.extract_text(spark.createDataFrame(rows, "page_id int, html string")).collect()}
    assert {k: got[k] for k in want} == want
    assert len(got[900].split()) == 60 and inner in got[901]


@pytest.mark.parametrize("piece", ['<a "', '<a "x" ', "<svg>", "<div>", "</section><div>", "<!-- ", "<!-- -->", "<p title='a", "&amp;<", "<head>", "<a> \" '", "<![CDATA[", "<script>", "</svg "])
def test_hostile_pages_take_linear_time(piece):
    began = time.time()
    htmltext.blocks_of(piece * (1_000_000 // len(piece)))
    assert time.time() - began < 4


# 9


def test_audio_round_trip(spark, docs, empty):
    out = audio.store_as_audio(docs)
    same_rows(docs, out, ["media"])
    by_text = {}
    for x in out.collect():
        raw = (x.text or "").encode()
        payload = raw + b"\0" * ((-len(raw)) % 64 or (0 if raw else 64))
        assert (x.n_bytes, x.payload_bytes, x.payload_sha256, x.tail_crc32) == (len(raw), len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-64:]))
        assert x.media_bytes == len(x.media) and x.media_sha256 == hashlib.sha256(x.media).hexdigest() and "bad_crc=0;skipped=0;table=Xing:ok" in x.feature
        assert by_text.setdefault(raw, (x.media_sha256, x.feature)) == (x.media_sha256, x.feature)
    assert audio.store_as_audio(empty).count() == 0


def test_streams_with_junk_and_damage(spark):
    whole = audio.write_stream(bytes(range(256)) * 64)
    n = len(audio.read_stream(whole)["seek"])
    at = audio.read_stream(whole)["seek"][3]
    broken = whole[: at + 5] + bytes([whole[at + 5] ^ 1]) + whole[at + 6 :]
    cases = [(1, whole), (2, b"\xff\xfb junk" + whole), (3, broken), (4, whole[:at] + b"garbage" + whole[at:]), (5, whole + b"TAG" + bytes(125)), (6, None), (7, b""), (8, b"\xff" * 500)]
    got = {x.k: x for x in audio.describe_streams(spark.createDataFrame(cases, "k int, media binary")).collect()}
    assert got[1].frames == n and got[1].samples == n * 1152 and got[1].sample_rate == 32000 and got[1].duration_s == n * 1152 / 32000 and got[1].vbr_table == "Xing" and got[1].tags == ["PRIV"]
    assert got[2].frames >= n and got[2].skipped > 0 and got[3].bad_crc == 1 and got[4].frames == n and got[4].skipped == 7
    assert "ID3v1" in got[5].tags and got[5].frames == n and [got[k].frames for k in (6, 7, 8)] == [0, 0, 0]
    assert all(whole[x : x + 2] == b"\xff\xfa" for x in got[1].seek_offsets)


def frame_of_bits(version, layer, rate, hertz, mode, size, checked=None, mode_ext=0):
    """A frame put together bit by bit from the format's description, not by the library's writer."""
    bits = "1" * 11 + version + layer + ("0" if checked else "1") + f"{rate:04b}{hertz:02b}00" + mode + f"{mode_ext:02b}" + "0000"
    head = int(bits, 2).to_bytes(4, "big")
    if not checked:
        return head + bytes(size - 4)
    register, covered = 0xFFFF, head[2:] + bytes(checked)
    for bit in "".join(f"{b:08b}" for b in covered):
        out = (register >> 15) ^ int(bit)
        register = (register << 1 & 0xFFFF) ^ (0x8005 if out else 0)
    return head + register.to_bytes(2, "big") + bytes(size - 6)


def test_streams_from_elsewhere(spark):
    """Streams of other versions and layers, with other tags and tables, with sizes and times worked out from the format."""
    layer1 = frame_of_bits("11", "11", 12, 0, "00", 416, checked=32) * 5  # MPEG-1 Layer I, 384 kbit/s, 44.1 kHz: 12 * 384000 / 44100 = 104 slots
    joint = frame_of_bits("11", "11", 12, 0, "01", 416, checked=16 + 2 * 3, mode_ext=2) * 4
    spoilt = layer1[:-400] + b"\x01" + layer1[-399:]
    layer2 = frame_of_bits("11", "10", 8, 1, "00", 384) * 3  # MPEG-1 Layer II, 128 kbit/s, 48 kHz: 144 * 128000 / 48000
    mpeg2 = frame_of_bits("10", "01", 8, 2, "11", 288) * 6  # MPEG-2 Layer III, 64 kbit/s, 16 kHz: 72 * 64000 / 16000
    title = b"TIT2" + (5).to_bytes(4, "big") + b"\0\0" + b"\0name"
    extended = (6).to_bytes(4, "big") + bytes(6)
    tag = b"ID3\x03\0\x40" + bytes([0, 0, 0, len(extended) + len(title)]) + extended + title
    vbri = bytearray(frame_of_bits("11", "01", 9, 0, "00", 417))
    vbri[36:36 + 30] = b"VBRI" + (1).to_bytes(2, "big") + bytes(4) + (417 * 3).to_bytes(4, "big") + (2).to_bytes(4, "big") + b"\0\2\0\1\0\2\0\1" + b"\1\xa1\1\xa1"
    vbr = bytes(vbri) + frame_of_bits("11", "01", 9, 0, "00", 417) * 2  # 144 * 128000 / 44100 = 417 bytes
    cases = [(1, layer1), (2, joint), (3, spoilt), (4, layer2), (5, tag + mpeg2), (6, vbr)]
    got = {x.k: x for x in audio.describe_streams(spark.createDataFrame([(k, bytearray(m)) for k, m in cases], "k int, media binary")).collect()}
    want = {1: (5, 5 * 384, 44100, 0), 2: (4, 4 * 384, 44100, 0), 3: (5, 5 * 384, 44100, 1), 4: (3, 3 * 1152, 48000, 0), 5: (6, 6 * 576, 16000, 0), 6: (2, 2 * 1152, 44100, 0)}
    for k, (frames, samples, rate, bad) in want.items():
        x = got[k]
        assert (x.frames, x.samples, x.sample_rate, x.bad_crc, x.skipped) == (frames, samples, rate, bad, 0), k
        assert x.duration_s == samples / rate
    assert got[1].seek_offsets == [416 * n for n in range(5)] and got[5].tags == ["TIT2"] and got[5].seek_offsets[0] == len(tag) and got[6].vbr_table == "VBRI" and got[6].seek_offsets == [417, 834]


def test_tag_in_the_payload(spark):
    """Payload bytes that read TAG where an ID3v1 tag would start are payload; a tag behind the frames is one."""
    texts = ["TAG" * 431, "guten TAG " * 300]
    for n in range(128, 3000, 64):
        whole = audio.write_stream(b"x" * n)
        at = n - 128 + len(whole) - len(whole.rstrip(b"\0"))  # the payload byte 128 before the end
        if at <= n - 3:
            texts.append("x" * at + "TAG" + "x" * (n - at - 3))
    hit = [t for t in texts if audio.write_stream(audio.padded(t.encode()))[-128:-125] == b"TAG"]
    assert len(hit) > 20
    for x in audio.store_as_audio(spark.createDataFrame([(t,) for t in texts], "text string")).collect():
        payload = audio.padded(x.text.encode())
        assert (x.payload_bytes, x.payload_sha256, x.tail_crc32) == (len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-64:]))
        assert "skipped=0;table=Xing:ok" in x.feature
    for t in hit:
        whole = audio.write_stream(audio.padded(t.encode()))
        plain, tagged, cut = (audio.read_stream(m) for m in (whole, whole + b"TAG" + bytes(125), whole[:-30] + b"TAG" + bytes(125)))
        assert not plain["id3v1"] and tagged["id3v1"] and cut["id3v1"] and plain["seek"] == tagged["seek"] == [*cut["seek"], plain["seek"][-1]]
        assert audio.payload_of(whole + b"TAG" + bytes(125), tagged) == audio.padded(t.encode())
    short = (0x7FF << 21 | 2 << 19 | 1 << 17 | 1 << 16 | 1 << 12 | 2 << 10 | 3 << 6).to_bytes(4, "big")  # 36-byte frames
    size = audio.header(int.from_bytes(short, "big"))["size"]
    body = bytearray((short + bytes(size - 4)) * 12)
    body[-128:-125] = b"TAG"
    assert size < 128 and len(audio.read_stream(bytes(body))["seek"]) == 12


# 10


def test_tokens(spark, docs, empty):
    public_tokenizers = pytest.importorskip("public_tokenizers")
    from tokenizers import Tokenizer

    path = public_tokenizers.path("byte_bpe_50k.json")
    t = Tokenizer.from_file(path)
    for huge, chunk, overlap in ((10**9, 100, 10), (200, 128, 16)):
        out = tokens.count_tokens(docs, path, huge=huge, chunk=chunk, overlap=overlap)
        same_rows(docs, out, ["n_tokens"])
        for x in out.collect():
            assert x.n_tokens == (len(t.encode(x.text, add_special_tokens=False).ids) if x.text else 0)
    assert tokens.count_tokens(empty, path).count() == 0


def test_resynchronisation_widens():
    public_tokenizers = pytest.importorskip("public_tokenizers")
    c = tokens.Counting(public_tokenizers.path("byte_bpe_50k.json"), 10, 64, 8)
    for text in ("a" * 500 + " b" * 50, " " * 300 + "x", "<|endoftext|>" * 40, "ab <|endoftext|>  c\n\n" * 30, "it's we'll " * 60):
        n, widened = tokens.resynchronised(c.encode, text, c.chunk, c.overlap)
        assert n == len(c.encode(text).ids)
    assert tokens.resynchronised(c.encode, "a" * 500 + " b" * 50, c.chunk, c.overlap)[1] > 0


def test_resynchronisation_reads_overlaps_only():
    """Chunks are asked for the pre-tokens of their overlaps, never for a list of all their tokens."""
    public_tokenizers = pytest.importorskip("public_tokenizers")
    c = tokens.Counting(public_tokenizers.path("byte_bpe_50k.json"), 10, 512, 32)
    asked = []

    class Chunk:
        def __init__(self, made):
            self.made = made

        def __len__(self):
            return len(self.made)

        def char_to_word(self, x):
            return self.made.char_to_word(x)

        def word_to_chars(self, k):
            asked.append(k)
            return self.made.word_to_chars(k)

        def word_to_tokens(self, k):
            return self.made.word_to_tokens(k)

    text = "ab cd, it's\n\n e\U0001f600 \u6f22\u5b57  " * 400
    n, widened = tokens.resynchronised(lambda t: Chunk(c.encode(t)), text, c.chunk, c.overlap)
    assert (n, widened) == (len(c.encode(text).ids), 0)
    assert len(asked) < len(text) / 10
