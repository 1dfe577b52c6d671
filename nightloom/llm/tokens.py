"""Token counts: huge documents are encoded in overlapping chunks that are spliced where both agree."""

from __future__ import annotations

import os
import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import add_columns, table

#: White space at which the library's own splitting always begins a new piece after a visible character.
PIECE = re.compile(r"[ \n\r\t]*[^ \n\r\t]+|[ \n\r\t]+")
OTHER_SPACE = re.compile(r"[^\S \n\r\t]|[\x1c-\x1f]")


def resynchronised(encode, text: str, chunk: int, overlap: int) -> tuple[int, int]:
    """Tokens of a long text, and how often the overlap had to grow.

    ``encode(text)`` gives the library's encoding. Each chunk starts in the tail of the one before. A
    position is a proven common boundary if in both encodings a pre-token (not just a token) starts there: the library
    splits from left to right without memory, so from there on the later chunk is split as the whole text
    is, and up to there the earlier one was, its own end being further on. If the overlap has no such position it is doubled,
    up to the whole remaining text. Encodings are asked for the pre-tokens of the overlap only.
    """
    total = widened = start = skipped = 0  # ``skipped`` tokens of ``first`` lie before ``start``, ``origin`` is where it begins
    first, origin = encode(text[:chunk]), 0
    end = min(chunk, len(text))
    while end < len(text):
        size = overlap
        while True:
            begin = max(start, end - size)
            stop = min(len(text), begin + max(chunk, 2 * size))
            second = encode(text[begin:stop])
            ahead = {x + origin: k - skipped for x, k in word_starts(first, begin - origin, end - origin) if x + origin >= start}
            # Not the chunk's own first position, which any text has as a boundary; nor behind white space, whose
            # splitting looks ahead to what the earlier chunk's end may have cut.
            common = next(((x + begin, k) for x, k in reversed(word_starts(second, 0, end - begin)) if x and x + begin in ahead and not text[x + begin - 1].isspace()), None)
            if common or begin == start:
                break
            size *= 2
            widened += 1
        if common is None:  # no boundary but the first: one chunk of the remaining text up to stop
            first, origin, skipped, end = second, begin, 0, stop
            chunk = max(chunk, 2 * (stop - start))
            if stop < len(text):
                end = min(len(text), start + chunk)
                first = encode(text[start:end])
            continue
        at, k = common
        total += ahead[at]
        # go on with the later chunk from the common boundary
        first, origin, skipped, start, end = second, begin, k, at, stop
    return total + len(first) - skipped, widened


def word_starts(encoding, low: int, high: int) -> list[tuple[int, int]]:
    """(offset, index of its first token) of each pre-token that starts in [low, high)."""
    word, at = None, low
    while word is None and at < high:
        word, at = encoding.char_to_word(at), at + 1
    found = []
    while word is not None and (span := encoding.word_to_chars(word)) and span[0] < high:
        if span[0] >= low:
            found.append((span[0], encoding.word_to_tokens(word)[0]))
        word += 1
    return found


class Counting:
    """Counts tokens of texts with one tokenizer file; lives in a task."""

    def __init__(self, path: str, huge: int, chunk: int, overlap: int, cached: int = 400_000):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        # An overlap holds any special string whole, so that no boundary inside one can look common.
        longest = max((len(t.content) for t in self.tokenizer.get_added_tokens_decoder().values()), default=0)
        self.huge, self.chunk, self.overlap, self.cached = huge, max(chunk, 4 * longest), max(overlap, 2 * longest + 2), cached
        self.known: dict[str, int] = {}

    def encode(self, text: str):
        return self.tokenizer.encode(text, add_special_tokens=False)

    def count(self, text: str | None) -> int:
        if not text:
            return 0
        if len(text) > self.huge:
            return resynchronised(self.encode, text, self.chunk, self.overlap)[0]
        if OTHER_SPACE.search(text):
            return len(self.encode(text).ids)
        pieces = PIECE.findall(text)
        counts = list(map(self.known.get, pieces))
        if None in counts:
            if len(self.known) > self.cached:
                self.known.clear()
                counts = [None] * len(pieces)
            missing = list({p for p, n in zip(pieces, counts, strict=True) if n is None})
            for p, e in zip(missing, self.tokenizer.encode_batch_fast(missing, add_special_tokens=False), strict=True):
                self.known[p] = len(e)
            counts = map(self.known.__getitem__, pieces)
        return sum(counts)


def count_tokens(docs: DataFrame, tokenizer: str, text: str = "text", column: str = "n_tokens", huge: int = 16_384, chunk: int = 8_192, overlap: int = 256) -> DataFrame:
    """Add ``column``: the number of tokens of each whole text, as the library's file ``tokenizer`` gives them.

    Texts of over ``huge`` characters go through :func:`resynchronised`. Shorter ones are cut where the
    library always cuts (before white space that follows a visible character), and each distinct piece
    is encoded once per task; texts with other white space are encoded as they are. Null and empty texts
    count 0. No row is dropped, no shuffle is needed, and a lost task is simply run again. A column of
    ``docs`` named as ``column`` is replaced. Empty tables stay empty and repeated rows count alike; a text of any length is encoded in chunks.
    """

    def start():
        counting = Counting(tokenizer, huge, chunk, overlap)
        return lambda texts: [[counting.count(t) for t in texts]]

    return add_columns(docs, text, f"`{column}` bigint", start)


def op10_token_counts(spark: SparkSession, sf_dir: str, tokenizer: str | None = None, limit: int = 1024) -> DataFrame:
    import public_tokenizers

    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    counted = count_tokens(docs, tokenizer or public_tokenizers.path("byte_bpe_50k.json"))
    return counted.select("doc_id", F.coalesce(F.octet_length("text"), F.lit(0)).cast("bigint").alias("n_bytes"), "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))
