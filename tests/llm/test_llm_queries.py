"""The registered corpus queries on the smallest tables: their contracts' columns, folds and row counts; SQL where there is some."""

import collections
import re
import zlib

import duckdb
import pytest

from nightloom.llm import queries

SF = "/root/testdata/sf0.001"
COLUMNS = {
    "op2_language_id": {"doc_id", "held_out", "lang_pred", "score"},
    "op3_url_rules": {"page_id", "host", "path", "rule", "verdict"},
    "op4_main_text": {"page_id", "url", "text", "n_chars"},
    "op5_mix_sources": {"doc_id", "size", "source_size", "target", "taken"},
    "op6_substring_dedup": {"doc_id", "n_words", "n_removed", "kept_sha256"},
    "op7_near_duplicates": {"doc_id", "class_id", "n_links", "n_copies"},
    "op8_katz_scores": {"doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"},
    "op9_mpeg_audio": {"doc_id", "n_bytes", "payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", "feature"},
    "op10_token_counts": {"doc_id", "n_bytes", "n_tokens", "over_limit"},
    "op12_periodic_runs": {"doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"},
    "op13_merkle_manifest": {"doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"},
}


@pytest.fixture(scope="module")
def documents(spark):
    return {x.doc_id: x for x in spark.read.parquet(f"{SF}/documents.parquet").collect()}


@pytest.mark.parametrize("name", sorted(COLUMNS))
def test_columns_and_rows(spark, documents, name):
    df = queries.queries()[name](spark, SF)
    rows = df.collect()
    pages = "page_id" in df.columns
    assert COLUMNS[name] <= set(df.columns)
    assert len(rows) == (spark.read.parquet(f"{SF}/pages.parquet").count() if pages else len(documents))
    if name in queries.oracle_sql():
        c = duckdb.connect()
        for t in ("documents", "pages"):
            c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
        cur = c.execute(queries.oracle_sql()[name])
        order = [[d[0] for d in cur.description].index(n) for n in df.columns]
        plain = lambda r: tuple(round(v, 7) if isinstance(v, float) else v for v in r)
        assert collections.Counter(map(plain, rows)) == collections.Counter(plain([r[k] for k in order]) for r in cur.fetchall())
    fold = {"op2_language_id": 4, "op8_katz_scores": 7}.get(name)
    for x in rows if fold else ():
        assert x.held_out == (zlib.crc32(str(x.doc_id).encode()) % fold == 2)
    if name == "op2_language_id":
        tried = [x for x in rows if x.held_out and len(documents[x.doc_id].text) > 60]
        assert sum(x.lang_pred == documents[x.doc_id].lang for x in tried) >= 0.95 * len(tried)
    if name == "op5_mix_sources":
        longest, taken = collections.Counter(), collections.Counter()
        for x in rows:
            s = documents[x.doc_id].source
            assert x.size == len(re.findall(r"[^\x20\x09-\x0D]+", documents[x.doc_id].text)) and x.taken <= 2 * x.size
            longest[s], taken[s] = max(longest[s], x.size), taken[s] + x.taken
        assert all(abs(taken[documents[x.doc_id].source] - x.target) <= longest[documents[x.doc_id].source] + 1 for x in rows)
    if name == "op8_katz_scores":
        held = [x for x in rows if x.held_out]
        assert sum(x.score for x in held) > sum(x.base_score for x in held)
    if name == "op10_token_counts":
        public_tokenizers = pytest.importorskip("public_tokenizers")
        from tokenizers import Tokenizer

        t = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
        for x in rows:
            assert x.n_tokens == len(t.encode(documents[x.doc_id].text, add_special_tokens=False).ids) and x.over_limit == (x.n_tokens > 1024)


def test_contaminated(spark, documents):
    """Whole items that stand in a text are found, each with its place."""
    items = {x.item_id: x.text for x in spark.read.parquet(f"{SF}/benchmark.parquet").collect()}
    want = {(d, i) for d, x in documents.items() for i, t in items.items() if t in x.text}
    got = {(x.doc_id, x.item_id) for x in queries.queries()["op1_decontaminate"](spark, SF).collect()}
    assert want and want <= got
