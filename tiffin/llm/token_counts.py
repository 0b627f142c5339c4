"""Token counts of whole texts, encoded in batches inside Arrow functions.

Only lengths leave a batch. Texts are encoded in calls of about equal bytes, so that one long text
neither swells a call nor waits for one: a long text is split where the tokenizer splits anyway, and the
lengths of its parts are added up. For tokenizers of byte-level BPE over white-space separated pieces
that is before a blank that follows a visible character: no piece spans that place, a piece before it
ends there whatever follows, and special strings have no blanks. The same places part a call into
words, and a task encodes a word it has not met lately only once, as a batch with the call's other new
words. Texts of tokenizers without such a rule (sentencepiece models, or other pre-tokenizers) are never split.

Defined cases: a NULL text counts as empty and has 0 tokens; a long text without a safe place is
encoded whole; identifiers may be NULL or repeated, one row goes in and one comes out; an empty table
gives an empty result; other columns are not read.
"""

from __future__ import annotations

import json
import os
import re
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

PIECE_BYTES = 64 << 10
CALL_BYTES = 512 << 10
LIMIT = 512
KNOWN_WORDS = 1 << 18
_SHORT = 64
_SAFE = re.compile(r"(?<=\S)(?=[ \n])")


def _utf8_size(text: str) -> int:
    return len(text) if text.isascii() else len(text.encode())


def safe_pieces(text: str, piece_chars: int) -> list[str]:
    """``text`` cut into parts of some ``piece_chars`` at places every tokenizer piece ends at."""
    pieces, start = [], 0
    while len(text) - start > piece_chars:
        cut = _next_cut(text, start + piece_chars)
        if cut < 0:
            break
        pieces.append(text[start:cut])
        start = cut
    pieces.append(text[start:])
    return pieces


def _next_cut(text: str, at: int) -> int:
    """The first place from ``at`` on with a blank after it and a visible character before it."""
    while True:
        blank, line = text.find(" ", at), text.find("\n", at)
        at = max(blank, line) if min(blank, line) < 0 else min(blank, line)
        if at < 0 or not text[at - 1].isspace():
            return at
        at += 1


def load_counter(path: str) -> tuple[Callable[[list[str]], list[int]], bool]:
    """A function from texts to token counts, and whether texts may be split at safe places."""
    if path.endswith(".model"):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        return lambda texts: [len(ids) for ids in model.encode(texts, num_threads=1)], False
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    tokenizer.no_truncation()
    tokenizer.no_padding()

    def count(texts: list[str]) -> list[int]:
        return [len(e) for e in tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    return count, _splits_at_blanks(path)


def _splits_at_blanks(path: str) -> bool:
    with open(path, encoding="utf-8") as file:
        parts = json.load(file)
    before = parts.get("pre_tokenizer") or {}
    return (
        before.get("type") == "ByteLevel"
        and before.get("use_regex", True)
        and not before.get("add_prefix_space", True)
        and not parts.get("normalizer")
        and not any(
            t["lstrip"] or t["rstrip"] or t["single_word"] or any(c.isspace() for c in t["content"])
            for t in parts["added_tokens"]
        )
    )


class WordCounter:
    """Token counts of texts from those of their words, each encoded once while it is remembered."""

    def __init__(self, count: Callable[[list[str]], list[int]], known_words: int = KNOWN_WORDS):
        self._count = count
        self._limit = known_words
        self._known: dict[str, int] = {}

    def __call__(self, texts: list[str]) -> list[int]:
        parted = [_SAFE.split(text) for text in texts]
        if len(self._known) > self._limit:
            self._known.clear()
        known = self._known
        new = list(set().union(*parted) - known.keys())
        known.update(zip(new, self._count(new), strict=True))
        totals = [sum(map(known.__getitem__, words)) for words in parted]
        for word in new:
            if len(word) > _SHORT:
                del known[word]
        return totals


def _lengths(path: str, piece_bytes: int, call_bytes: int):
    def lengths(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count, may_split = load_counter(path)
        if may_split:
            count = WordCounter(count)
        for batch in batches:
            totals = [0] * batch.num_rows
            for call in _calls(batch.column(1), piece_bytes if may_split else None, call_bytes):
                rows, texts = zip(*call, strict=True)
                for row, n in zip(rows, count(list(texts)), strict=True):
                    totals[row] += n
            columns = [batch.column(0), batch.column(2), pa.array(totals, pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "n_bytes", "n_tokens"])

    return lengths


def _calls(
    texts: pa.Array, piece_bytes: int | None, call_bytes: int
) -> Iterator[list[tuple[int, str]]]:
    """``(row, piece)`` lists of some ``call_bytes`` of UTF-8 each."""
    call: list[tuple[int, str]] = []
    size = 0
    for row in range(len(texts)):
        text = texts[row].as_py()
        if not text:
            continue
        n_bytes = _utf8_size(text)
        if piece_bytes is None or n_bytes <= piece_bytes:
            pieces = [text]
        else:
            # As many characters as take up ``piece_bytes`` in this text.
            pieces = safe_pieces(text, max(1, piece_bytes * len(text) // n_bytes))
        for piece in pieces:
            call.append((row, piece))
            size += n_bytes if len(pieces) == 1 else _utf8_size(piece)
            if size >= call_bytes:
                yield call
                call, size = [], 0
    if call:
        yield call


def token_counts(
    docs: DataFrame, tokenizer_path: str, key: str = "doc_id", text: str = "text",
    limit: int = LIMIT, piece_bytes: int = PIECE_BYTES, call_bytes: int = CALL_BYTES,
) -> DataFrame:
    """``(doc_id, n_bytes, n_tokens, over_limit)``, one row per row of ``docs``.

    ``tokenizer_path`` names a file that every executor has.
    """
    filled = F.coalesce(F.col(text), F.lit(""))
    rows = docs.select(
        F.col(key).alias("doc_id"),
        filled.alias("text"),
        F.octet_length(filled).cast("long").alias("n_bytes"),
    )
    id_type = rows.schema["doc_id"].dataType.simpleString()
    counted = rows.mapInArrow(
        _lengths(tokenizer_path, piece_bytes, call_bytes),
        f"doc_id {id_type}, n_bytes long, n_tokens long",
    )
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)
