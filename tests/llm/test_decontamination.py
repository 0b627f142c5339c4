"""Decontamination: Wu-Manber against plain search, and the operator against brute force."""

from __future__ import annotations

import hashlib
import random
import re

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tiffin.llm.decontamination import contamination, words_of
from tiffin.llm.wu_manber import WuManber

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def plain_search(text, patterns):
    return sorted(
        (at, i) for i, p in enumerate(patterns) for at in range(len(text)) if text.startswith(p, at)
    )


@settings(max_examples=300, deadline=None)
@given(
    st.lists(st.text("ab ", min_size=1, max_size=14), min_size=1, max_size=6, unique=True),
    st.text("ab ", max_size=200),
)
def test_search(patterns, text):
    patterns = [p.encode() for p in patterns]
    got = WuManber(patterns).occurrences(text.encode())
    assert sorted(got) == plain_search(text.encode(), patterns)


def test_search_over_many_lanes_and_skips():
    rng = random.Random(1)
    text = " ".join(f"word{rng.randrange(4000)}" for _ in range(30_000))
    cuts = [rng.randrange(len(text) - 80) for _ in range(50)]
    patterns = sorted({text[c : c + rng.randrange(40, 80)].encode() for c in cuts})
    search = WuManber(patterns)
    got = search.occurrences(text.encode())
    assert sorted(got) == plain_search_fast(text.encode(), patterns)
    assert search.looked_at < len(text) / 10


def plain_search_fast(text, patterns):
    return sorted((m.start(), i) for i, p in enumerate(patterns) for m in re.finditer(b"(?=" + p + b")", text))


def words(text):
    lowered = (text or "").translate(str.maketrans(UPPER, LOWER))
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered)


def expected(docs, items, width=10):
    windows = []
    for item, text in items:
        own = words(text)
        if own:
            windows += [(item, own[i : i + width]) for i in range(max(1, len(own) - width + 1))]
    out = []
    for doc_id, text in docs:
        own, hit, found = words(text), set(), set()
        for item, window in windows:
            for i in range(len(own) - len(window) + 1):
                if own[i : i + len(window)] == window:
                    hit.update(range(i, i + len(window)))
                    found |= {str(item)} - {"None"}
        digest = hashlib.sha256(",".join(sorted(found)).encode()).hexdigest()
        out.append((doc_id, len(own), len(hit), len(found), digest, bool(hit)))
    return sorted(out, key=repr)


def found(df):
    columns = ["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"]
    return sorted(map(tuple, df.select(*columns).collect()), key=repr)


@pytest.fixture(scope="module")
def case():
    rng = random.Random(3)
    vocabulary = [f"{a}{b}" for a in ("ab", "é", "x1", "the") for b in ("", "u", "ß")]
    items = [(i, " ".join(rng.choice(vocabulary) for _ in range(rng.randrange(1, 30)))) for i in range(25)]
    items += [(30, items[3][1]), (30, items[3][1]), (31, None), (32, " -- "), (None, "the"), (2, "the x1 ab"), (33, "Z")]
    docs = []
    for i in range(60):
        parts = [rng.choice(vocabulary + ["z", "q9"]) for _ in range(rng.randrange(0, 40))]
        item = words(rng.choice(items)[1])
        start = rng.randrange(len(item) + 1)
        parts[3:3] = item[start : start + rng.randrange(5, 14)]
        docs.append((i, rng.choice([" ", ", ", "\n", "!-"]).join(p.upper() for p in parts)))
    docs += [(70, None), (70, ""), (None, "the x1 ab"), (71, "\x00\x7f"), (72, "the " * 20_000)]
    return docs, items


def test_words():
    assert words_of("Ab-c_É d9[x]".encode()) == [w.encode() for w in words("Ab-c_É d9[x]")]


@pytest.mark.parametrize("group_bytes", [300, 8 << 20])
def test_against_brute_force(spark, documents, case, group_bytes):
    docs, items = case
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    got = contamination(documents(*docs), benchmark, group_bytes=group_bytes)
    assert found(got) == expected(docs, items)


def test_empty_tables(spark, documents):
    items = spark.createDataFrame([(1, "a b c")], "item_id long, text string")
    none = spark.createDataFrame([], "item_id long, text string")
    assert found(contamination(documents(), items)) == []
    docs = [(1, "a b c"), (2, None)]
    assert found(contamination(documents(*docs), none)) == expected(docs, [])


def test_clashing_columns(spark):
    docs = spark.createDataFrame(
        [(1, "x a b c", "r", 5, ["i"])],
        "doc_id long, text string, row string, n_words int, items array<string>",
    )
    items = spark.createDataFrame([("i-7", "a b", 1)], "item_id string, text string, part int")
    assert found(contamination(docs, items)) == expected([(1, "x a b c")], [("i-7", "a b")])
