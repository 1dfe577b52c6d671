import random

import pytest

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, score double, matches string, n_tokens string, size int, host string"
WORDS = {"en": "the of and that with for are was this from have which tion ing ed er".split(), "de": "der die und ein ist nicht auf sich den mit sch ung keit zu".split()}


def sentence(r, lang, n):
    w = WORDS[lang]
    return " ".join("".join(r.choice(w) for _ in range(r.choice([1, 1, 2, 3]))) for _ in range(n))


def document_rows(seed=1, n=120):
    """Documents with copies, near copies, shared passages, nulls, empty and odd texts."""
    r = random.Random(seed)
    rows, passage = [], sentence(r, "en", 60)
    for k in range(n):
        lang = r.choice(["en", "de"])
        text = sentence(r, lang, r.choice([3, 40, 90, 200]))
        if k % 7 == 3:
            text = text + "\n" + passage + "\t" + sentence(r, lang, 20)
        rows.append([k, text, lang, f"src{k % 5}"])
    for k in range(0, 40, 4):
        rows.append([1000 + k, rows[k][1], rows[k][2], "src0"])  # exact copies
        words = rows[k][1].split(" ")
        if len(words) > 60:
            words[10] = "changed"
            rows.append([2000 + k, " ".join(words), rows[k][2], "src1"])  # near copies
    odd = [None, "", " \n\t ", "a", "12345 !!", "ab " * 400, "x" * 3000, "é" * 500, "日本語 テキスト", "A\u00a0b\x0bC\x1cd <|endoftext|> e", "one two three four"]
    rows += [[3000 + k, t, [None, "en", "de"][k % 3], [None, "", "src9"][k % 3]] for k, t in enumerate(odd)]
    rows += [[5, rows[5][1], rows[5][2], rows[5][3]], [None, "no id here", "en", None], [None, None, None, None]]
    return [(*x, len(x[1]) if x[1] is not None else None, 1.5, "m", "n", 7, "h") for x in rows]


@pytest.fixture(scope="session")
def docs(spark):
    return spark.createDataFrame(document_rows(), SCHEMA).repartition(5)


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)
