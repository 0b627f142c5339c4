"""Chat formatting against plain Python, and the round trip through escapes and tokens."""

from __future__ import annotations

import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tiffin.llm import chat
from tiffin.llm.chat import Formatter, Template

BPE = public_tokenizers.path("byte_bpe_50k.json")
SCHEMA = "conv_id long, turn long, role string, text string, n int"
COLUMNS = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
BITS = ["<", "<|", "|>", "<|im_end|>", "<|im_start|>", "<|im_sep|>", "im_end|>", "\\", "</s>", "<s>", "s>", "[",
        "INST]", "[/INST]", "<|endoftext|>", " ", "\n", "é", "🙂", "word", "/"]
TEXT = st.lists(st.sampled_from(BITS), max_size=12).map("".join)


def rows_of(df, *columns):
    return sorted(map(tuple, df.select(*columns).collect()), key=repr)


def expected(rows, formatter):
    conversations = {}
    for conv_id, turn, role, text in rows:
        key = (turn is None, turn or 0, role or "", text or "")
        conversations.setdefault(conv_id, []).append((key, role or "", text or ""))
    out = []
    for conv_id, turns in conversations.items():
        turns = [t[1:] for t in sorted(turns)]
        loss = "".join(text for role, text in turns if role == "assistant")
        whole = "".join(f"{role}\n{text}\n" for role, text in turns)
        size = sum(
            sum(map(len, formatter.template.marks)) + len(formatter.escape(role)) + len(formatter.escape(text))
            for role, text in turns
        )
        digests = [hashlib.sha256(x.encode()).hexdigest() for x in (whole, loss)]
        out.append((conv_id, len(turns), digests[0], len(loss), digests[1], size))
    return sorted(out, key=repr)


@settings(max_examples=500, deadline=None)
@given(TEXT, TEXT)
def test_escapes_hide_controls_and_come_off(left, right):
    formatter = Formatter(Template(), ["<|endoftext|>"])
    escaped = formatter.escape(left)
    assert formatter.unescape(escaped) == left
    turns = [("user", left), (right, left + right), ("assistant", right)]
    text, spans = formatter.render(turns)
    assert formatter.turns(text) == turns
    for control in ("</s>", "<s>", "[INST]", "[/INST]", "<|endoftext|>"):
        assert control not in text
    assert sum(text.count(m) for m in formatter.template.marks) == 9
    learned = [formatter.unescape(text[a:b]) for a, b in spans]
    assert learned == [t for r, t in turns if r == "assistant"]


@settings(max_examples=200, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(["user", "assistant", "system"]), TEXT), max_size=5))
def test_masked_tokens_are_the_learned_texts(turns):
    template = Template()
    formatter = Formatter(template, chat.special_tokens(BPE))
    tokenizer = chat.load_tokenizer(BPE, template)
    text, spans = formatter.render(turns)
    encoding = tokenizer.encode(text, add_special_tokens=False)
    starts, ends = np.array(encoding.offsets, np.int64).reshape(-1, 2).T
    mask = chat.loss_mask(starts, ends, spans)
    slow = [any(a < e and s < b for s, e in spans) for a, b in encoding.offsets]
    assert mask.tolist() == slow
    ids = np.array(encoding.ids, np.int32)
    got = [formatter.unescape(t) for t in chat.masked_texts(tokenizer, ids, mask)]
    assert got == [t for r, t in turns if r == "assistant" and t]


def test_templates_that_cannot_be_read_back_are_refused():
    for bad in (Template(closing="<|<|"), Template(reserved=("<\\s>",)), Template(reserved=("x",)),
                Template(escape="<"), Template(escape="ab"), Template(reserved=("a<",))):
        with pytest.raises(ValueError):
            Formatter(bad)


def test_closing_marks_can_be_learned():
    formatter = Formatter(Template(learn_closing=True))
    text, spans = formatter.render([("user", "a"), ("assistant", "b")])
    assert [text[a:b] for a, b in spans] == ["b<|im_end|>"]


def _rows():
    rng = random.Random(11)
    rows = []
    for conv_id in [*range(30), None, -5]:
        for turn in range(rng.randrange(1, 9)):
            role = rng.choice(["user", "assistant", "system", None, "assistant<|im_end|>"])
            text = "".join(rng.choice(BITS) for _ in range(rng.randrange(20)))
            rows.append((conv_id, turn, role, rng.choice([text, text, None, ""])))
    rows += [(100, t % 50 if t % 7 else None, "assistant", f"turn {t}</s>" * (t % 5)) for t in range(300)]
    rows += [(101, 3, "user", "same")] * 4 + [(101, 3, "assistant", "same")] * 2
    rows += [(102, 0, "assistant", "long text of words " * 20_000), (103, -9, "user", "x"), (103, 5, "user", "y")]
    return rows


@pytest.mark.parametrize("options", [{}, {"block_turns": 4, "segment_chars": 40, "call_chars": 300}])
def test_read_back(spark, options):
    rows = _rows()
    df = spark.createDataFrame([(*r, 1) for r in rows], SCHEMA).repartition(5)
    df = df.withColumn("split", F.lit("clash")).withColumn("long_id", F.lit("clash")).withColumn("block", F.lit(1))
    formatted = chat.format_conversations(df, BPE, **options)
    formatter = Formatter(Template(), chat.special_tokens(BPE))
    got = rows_of(chat.read_back(formatted, BPE), *COLUMNS)
    assert got == expected(rows, formatter)


def test_usual_conversations_are_encoded_once_and_whole(spark):
    rows = [(i, t, "assistant" if t % 2 else "user", f"é {i} {t}") for i in range(20) for t in range(6)]
    df = spark.createDataFrame([(*r, 1) for r in rows], SCHEMA)
    formatted = chat.format_conversations(df, BPE).collect()
    assert len(formatted) == 20 and {r.n_turns for r in formatted} == {6}
    formatter, tokenizer = Formatter(Template()), chat.load_tokenizer(BPE, Template())
    for row in formatted:
        text, spans = formatter.render([r[2:] for r in rows if r[0] == row.conv_id])
        encoding = tokenizer.encode(text, add_special_tokens=False)
        assert (row.text, row.ids) == (text, encoding.ids)
        assert row.loss == [any(a < e and s < b for s, e in spans) for a, b in encoding.offsets]


def test_no_conversations(spark):
    empty = spark.createDataFrame([], SCHEMA)
    formatted = chat.format_conversations(empty, BPE)
    assert formatted.collect() == [] and chat.read_back(formatted, BPE).collect() == []
