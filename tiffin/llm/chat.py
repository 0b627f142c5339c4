"""Conversations as token sequences with a mask of what is learned.

A conversation is rendered whole, encoded once with offsets, and the sorted spans of the learned turns are
intersected with the token spans by binary search. The marks of the template are special tokens that the
tokenizer gets on top of its file, so no token reaches over the edge of a text, and a conversation may be cut
between turns without changing a token.

Control strings inside roles and texts are escaped: the marks, the special tokens of the tokenizer's file and
the template's ``reserved`` strings get an escape character after their first one, and one more where they
already have some. No control string has the escape character, or the first character of any control string at
a later place. So two of them never overlap, an escaped text has them at the same places, and taking
one escape character out gives the text back.

Long conversations: turns meet by ``turn`` divided by ``block_turns``. Usual conversations are one block; one
that owns a third of all rows is spread over tasks by its turn numbers. Tasks stream sorted rows and give a
segment off after ``segment_chars`` characters, so they hold one segment and one call of the tokenizer.

Defined cases: a NULL text or role counts as empty; rows without ``conv_id`` are one conversation; rows without
``turn`` come last; rows of the same turn are ordered by role and text, and repeated rows are turns of their
own; an empty text has no token and nothing to learn; an empty table gives an empty result; other columns are
not read. Tokenizers are files of the ``tokenizers`` library. What the mask covers equals the learned texts to
the character where the tokenizer keeps every character (byte-level ones without a normalizer).
"""

from __future__ import annotations

import hashlib
import json
import os
import re
from collections import defaultdict
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tiffin.llm.scratch import Scratch

BLOCK_TURNS = 1024
SEGMENT_CHARS = 1 << 20
CALL_CHARS = 1 << 19

Turn = tuple[str, str]
Span = tuple[int, int]


@dataclass(frozen=True)
class Template:
    """``opening`` role ``middle`` text ``closing``, for each turn.

    Texts of the ``learned`` roles are learned, with ``learn_closing`` also the mark that ends them.
    """

    opening: str = "<|im_start|>"
    middle: str = "<|im_sep|>"
    closing: str = "<|im_end|>"
    learned: tuple[str, ...] = ("assistant",)
    learn_closing: bool = False
    reserved: tuple[str, ...] = ("<s>", "</s>", "[INST]", "[/INST]", "<|endoftext|>")
    escape: str = "\\"

    @property
    def marks(self) -> tuple[str, str, str]:
        return self.opening, self.middle, self.closing


class Formatter:
    """Renders turns with a template and reads them back."""

    def __init__(self, template: Template, special: Iterable[str] = ()):
        controls = sorted({*template.marks, *template.reserved, *special})
        tails = defaultdict(list)
        for control in controls:
            tails[control[:1]].append(re.escape(control[1:]))
        for control in controls:
            if len(control) < 2 or {template.escape, *tails} & set(control[1:]):
                raise ValueError(f"{control!r} cannot be told from escaped text")
        if len(template.escape) != 1 or template.escape in tails:
            raise ValueError("the escape must be one character that begins no control string")
        self.template = template
        escape = re.escape(template.escape)

        def places(extra: str) -> re.Pattern:
            return re.compile(
                "|".join(f"{re.escape(c)}{extra}(?={escape}*(?:{'|'.join(t)}))" for c, t in tails.items())
            )

        self._bare, self._escaped = places(""), places(escape)
        self._mark = re.compile("|".join(map(re.escape, template.marks)))

    def escape(self, text: str) -> str:
        return self._bare.sub(lambda found: found[0] + self.template.escape, text)

    def unescape(self, text: str) -> str:
        return self._escaped.sub(lambda found: found[0][:1], text)

    def render(self, turns: Iterable[Turn]) -> tuple[str, list[Span]]:
        """The formatted text, and where in it what is learned begins and ends."""
        template, parts, spans, at = self.template, [], [], 0
        for role, text in turns:
            head = f"{template.opening}{self.escape(role)}{template.middle}"
            body = self.escape(text)
            start, at = at + len(head), at + len(head) + len(body) + len(template.closing)
            if role in template.learned:
                spans.append((start, at if template.learn_closing else start + len(body)))
            parts += (head, body, template.closing)
        return "".join(parts), spans

    def turns(self, text: str) -> list[Turn]:
        """The turns of a formatted text."""
        parts = self._mark.split(text)
        pairs = zip(parts[1::3], parts[2::3], strict=True)
        return [(self.unescape(role), self.unescape(body)) for role, body in pairs]


def special_tokens(path: str) -> list[str]:
    """The special tokens that a tokenizer's file names."""
    with open(path, encoding="utf-8") as file:
        added = json.load(file).get("added_tokens") or []
    return [token["content"] for token in added]


def load_tokenizer(path: str, template: Template):
    """The tokenizer with the template's marks, and with offsets that leave no character out."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import AddedToken, Tokenizer, processors

    tokenizer = Tokenizer.from_file(path)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    tokenizer.post_processor = processors.ByteLevel(trim_offsets=False)
    tokenizer.add_special_tokens([AddedToken(m, special=True, normalized=False) for m in template.marks])
    return tokenizer


def loss_mask(starts: np.ndarray, ends: np.ndarray, spans: list[Span]) -> np.ndarray:
    """Which tokens share a character with a span; tokens and spans are sorted, spans are disjoint."""
    changes = np.zeros(len(starts) + 1, np.int64)
    edges = np.array(spans, np.int64).reshape(-1, 2)
    first = np.searchsorted(ends, edges[:, 0], "right")
    behind = np.maximum(first, np.searchsorted(starts, edges[:, 1], "left"))
    np.add.at(changes, first, 1)
    np.add.at(changes, behind, -1)
    return np.cumsum(changes[:-1]) > 0


_FORMATTED = (
    "conv_id {id}, split boolean, block long, segment long, n_turns long, text string, "
    "ids array<int>, loss array<boolean>"
)


class _Segments:
    """Collects turns of one block at a time; gives segments off with their tokens, a call at a time."""

    def __init__(self, path: str, template: Template, segment_chars: int, call_chars: int):
        self._formatter = Formatter(template, special_tokens(path))
        self._tokenizer = load_tokenizer(path, template)
        self._segment_chars, self._call_chars = segment_chars, call_chars
        self._key, self._turns, self._chars, self._segment = None, [], 0, 0
        self._waiting: list[tuple] = []
        self._waiting_chars = 0

    def add(self, key: tuple, role: str, text: str) -> bool:
        """Takes a turn; says whether a call is full."""
        if key != self._key:
            self._cut()
            self._key, self._segment = key, 0
        elif self._chars >= self._segment_chars:
            self._cut()
        self._turns.append((role, text))
        self._chars += len(role) + len(text)
        return self._waiting_chars >= self._call_chars

    def _cut(self) -> None:
        if self._turns:
            text, spans = self._formatter.render(self._turns)
            self._waiting.append((*self._key, self._segment, len(self._turns), text, spans))
            self._waiting_chars += len(text)
            self._turns, self._chars, self._segment = [], 0, self._segment + 1

    def call(self, id_type: pa.DataType, last: bool = False) -> pa.RecordBatch:
        """Encodes what waits; ``last`` adds the segment in work."""
        if last:
            self._cut()
        encodings = self._tokenizer.encode_batch([w[5] for w in self._waiting], add_special_tokens=False)
        ids, masks = [], []
        for waiting, encoding in zip(self._waiting, encodings, strict=True):
            numbers = encoding.ids
            offsets = np.fromiter(chain.from_iterable(encoding.offsets), np.int64, 2 * len(numbers))
            ids.append(np.array(numbers, np.int32))
            masks.append(loss_mask(offsets[::2], offsets[1::2], waiting[6]))
        columns = list(zip(*self._waiting, strict=True)) or [()] * 7
        types = (id_type, pa.bool_(), pa.int64(), pa.int64(), pa.int64(), pa.string())
        arrays = [pa.array(c, t) for c, t in zip(columns, types, strict=False)]
        arrays += [pa.array(ids, pa.list_(pa.int32())), pa.array(masks, pa.list_(pa.bool_()))]
        self._waiting, self._waiting_chars = [], 0
        names = ["conv_id", "split", "block", "segment", "n_turns", "text", "ids", "loss"]
        return pa.RecordBatch.from_arrays(arrays, names=names)


def _formatting(path: str, template: Template, segment_chars: int, call_chars: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        segments, id_type = _Segments(path, template, segment_chars, call_chars), None
        for batch in batches:
            id_type = batch.schema.field(0).type
            rows = zip(*(batch.column(i).to_pylist() for i in range(5)), strict=True)
            for conv_id, split, block, role, text in rows:
                if segments.add((conv_id, split, block), role, text):
                    yield segments.call(id_type)
        if id_type is not None:
            yield segments.call(id_type, last=True)

    return run


def format_conversations(
    conversations: DataFrame, tokenizer_path: str, template: Template = Template(),
    block_turns: int = BLOCK_TURNS, segment_chars: int = SEGMENT_CHARS, call_chars: int = CALL_CHARS,
) -> DataFrame:
    """``(conv_id, split, block, segment, n_turns, text, ids, loss)``, in most cases a row per conversation.

    ``text`` is what was encoded, ``ids`` its tokens and ``loss`` which of them are learned. ``split`` tells that
    a conversation may have several blocks. ``tokenizer_path`` names a file that every executor has.
    """
    scratch = Scratch(conversations.sparkSession, "chat")
    turn = F.col("turn").cast("long")
    # Turns without a number come after all others.
    block = F.coalesce(F.floor(turn / F.lit(block_turns)), F.lit(2**63 - 1)).cast("long")
    rows = conversations.select(
        "conv_id",
        turn.alias("turn"),
        block.alias("block"),
        F.coalesce("role", F.lit("")).alias("role"),
        F.coalesce("text", F.lit("")).alias("text"),
    )
    # Stored, so that Spark joins it by its size on disk.
    long = scratch.store(rows.filter("block != 0").select(F.col("conv_id").alias("long_id")).distinct(), "long")
    marked = rows.join(
        long.withColumn("split", F.lit(True)), F.col("conv_id").eqNullSafe(F.col("long_id")), "left"
    )
    ordered = (
        marked.withColumn("split", F.coalesce("split", F.lit(False)))
        .repartition("conv_id", "block")
        .sortWithinPartitions("conv_id", "block", "turn", "role", "text")
        .select("conv_id", "split", "block", "role", "text")
    )
    id_type = rows.schema["conv_id"].dataType.simpleString()
    run = _formatting(tokenizer_path, template, segment_chars, call_chars)
    return ordered.mapInArrow(run, _FORMATTED.format(id=id_type))


class _Digest:
    """Running digests of the turns and the learned texts of one conversation."""

    def __init__(self):
        self.n_turns = self.loss_chars = self.formatted_chars = 0
        self.turns, self.loss = hashlib.sha256(), hashlib.sha256()

    def add(self, n_turns: int, turns: bytes, loss: bytes, loss_chars: int, formatted_chars: int) -> None:
        self.n_turns += n_turns
        self.turns.update(turns)
        self.loss.update(loss)
        self.loss_chars += loss_chars
        self.formatted_chars += formatted_chars

    def row(self) -> tuple:
        return (
            self.n_turns, self.turns.hexdigest(), self.loss_chars, self.loss.hexdigest(), self.formatted_chars
        )


_DIGESTS = (
    "n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"
)
_DIGEST_TYPES = (pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64())
_DIGEST_NAMES = [part.split()[0] for part in _DIGESTS.split(", ")]
_ROWS_OUT = 4096


def _read_segments(path: str, template: Template):
    """Digests of whole conversations; the read-back bytes of segments of split ones."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        formatter, tokenizer = Formatter(template, special_tokens(path)), load_tokenizer(path, template)
        held, digest, out, id_type = None, None, [], None

        def flush() -> pa.RecordBatch:
            columns = list(zip(*out, strict=True)) or [()] * 10
            types = (id_type, pa.int64(), pa.int64(), *_DIGEST_TYPES, pa.binary(), pa.binary())
            out.clear()
            return pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, types, strict=True)],
                names=["conv_id", "block", "segment", *_DIGEST_NAMES, "turns", "loss"],
            )

        for batch in batches:
            id_type = batch.schema.field(0).type
            for i in range(batch.num_rows):
                conv_id, split, block, segment, n_turns, text = (batch.column(c)[i].as_py() for c in range(6))
                ids = batch.column(6)[i].values.to_numpy()
                mask = batch.column(7)[i].values.to_numpy(zero_copy_only=False)
                turns = "".join(f"{role}\n{body}\n" for role, body in formatter.turns(text)).encode()
                loss = "".join(map(formatter.unescape, masked_texts(tokenizer, ids, mask)))
                if digest and (split or held != conv_id):
                    out.append((held, 0, 0, *digest.row(), None, None))
                    digest = None
                if split:
                    row = (conv_id, block, segment, n_turns, None, len(loss), None, len(text))
                    out.append((*row, turns, loss.encode()))
                else:
                    held, digest = conv_id, digest or _Digest()
                    digest.add(n_turns, turns, loss.encode(), len(loss), len(text))
                if len(out) >= _ROWS_OUT or split:
                    yield flush()
        if digest:
            out.append((held, 0, 0, *digest.row(), None, None))
        if id_type is not None:
            yield flush()

    return run


def masked_texts(tokenizer, ids: np.ndarray, mask: np.ndarray) -> list[str]:
    """The texts that stretches of tokens under the mask stand for, one per stretch."""
    edges = np.flatnonzero(np.diff(np.concatenate(([0], mask.astype(np.int8), [0]))))
    stretches = [ids[a:b].tolist() for a, b in zip(edges[::2], edges[1::2], strict=True)]
    return tokenizer.decode_batch(stretches, skip_special_tokens=False) if stretches else []


def _join_digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per conversation, from the sorted segments of split ones."""
    held, digest, out, id_type = None, None, [], None
    for batch in batches:
        id_type = batch.schema.field(0).type
        for conv_id, *parts in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if digest and held != conv_id:
                out.append((held, *digest.row()))
                digest = None
            held, digest = conv_id, digest or _Digest()
            digest.add(*parts)
    if digest:
        out.append((held, *digest.row()))
    if out:
        columns = zip(*out, strict=True)
        types = (id_type, *_DIGEST_TYPES)
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=["conv_id", *_DIGEST_NAMES]
        )


def read_back(formatted: DataFrame, tokenizer_path: str, template: Template = Template()) -> DataFrame:
    """Digests of what the output of :func:`format_conversations` holds, one row per conversation.

    Turns come from ``text``, what is learned from the ``ids`` under the mask (``learn_closing`` must be off).
    ``(conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars)``. Rows must come as the
    operator gives them. A split conversation passes through one task in order, as a SHA-256 is made in order.
    """
    scratch = Scratch(formatted.sparkSession, "chat_read")
    id_type = formatted.schema["conv_id"].dataType.simpleString()
    schema = f"conv_id {id_type}, block long, segment long, {_DIGESTS}, turns binary, loss binary"
    read = scratch.store(formatted.mapInArrow(_read_segments(tokenizer_path, template), schema), "read")
    whole = read.filter("turns is null").select("conv_id", *_DIGEST_NAMES)
    parts = (
        read.filter("turns is not null")
        .repartition("conv_id")
        .sortWithinPartitions("conv_id", "block", "segment")
        .select("conv_id", "n_turns", "turns", "loss", "loss_chars", "formatted_chars")
    )
    return whole.unionAll(parts.mapInArrow(_join_digests, f"conv_id {id_type}, {_DIGESTS}"))
