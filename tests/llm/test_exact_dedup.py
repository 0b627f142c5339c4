"""Exact dedup: tries against dictionaries, and the operator against brute force."""

from __future__ import annotations

import hashlib
import random
import re

import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from tiffin.llm import exact_dedup
from tiffin.llm.exact_dedup import PatriciaTrie, exact_duplicates

COLUMNS = ["doc_id", "keep_id", "group_size", "kept", "text_sha256"]


def expected(rows):
    norm = [re.sub(r"[\x20\x09-\x0D]+", " ", r[1] or "") for r in rows]
    out = []
    for (doc_id, *_), text in zip(rows, norm, strict=True):
        ids = [r[0] for r, t in zip(rows, norm, strict=True) if t == text]
        known = [i for i in ids if i is not None]
        keep = min(known) if known else None
        out.append((doc_id, keep, len(ids), doc_id == keep, hashlib.sha256(text.encode()).hexdigest()))
    return sorted(out, key=repr)


def found(df):
    return sorted(map(tuple, df.select(*COLUMNS).collect()), key=repr)


@settings(max_examples=100, deadline=None)
@given(st.lists(st.tuples(st.binary(max_size=6), st.one_of(st.none(), st.integers(0, 9)))))
def test_trie_is_a_dictionary(keys):
    trie, plain = PatriciaTrie(), {}
    for key, smallest in keys:
        trie.insert(key, smallest, 1)
        old, n = plain.get(key, (None, 0))
        plain[key] = (smallest if old is None else old if smallest is None else min(old, smallest), n + 1)
    assert {k: (s, n) for k, s, n in trie.take()} == plain
    assert list(trie.take()) == []


def test_trie_keeps_the_open_subtree():
    trie = PatriciaTrie()
    for key in (b"aa1", b"aa2", b"ab1", b"b"):
        trie.insert(key, 1, 1)
    assert {k for k, _, _ in trie.give_off(0, keep=b"aa")} == {b"ab1", b"b"}
    assert {k for k, _, _ in trie.take()} == {b"aa1", b"aa2"}


@settings(max_examples=200, deadline=None)
@given(st.lists(st.tuples(st.binary(max_size=5), st.integers(1, 50))), st.integers(0, 4000), st.binary(max_size=2))
def test_what_is_given_off_and_what_stays_add_up(keys, most, keep):
    trie, plain = PatriciaTrie(), {}
    for key, copies in keys:
        trie.insert(key, 1, copies)
        plain[key] = plain.get(key, 0) + copies
    gone = {k: n for k, _, n in trie.give_off(most, keep)}
    assert not any(k.startswith(keep) for k in gone)
    sizes = exact_dedup._sizes(trie.root)[id(trie.root)][0] - exact_dedup._NODE_BYTES
    assert trie.size == sizes
    kept = {k: n for k, _, n in trie.take()}
    assert gone.keys().isdisjoint(kept) and gone | kept == plain
    # Beyond the budget only what must stay is left: kept keys, and keys that lead to them or to the root.
    if sizes > most:
        assert all(k.startswith(keep) or keep.startswith(k) or any(o != k and o.startswith(k) for o in plain) for k in kept)


def test_a_hot_text_stays_in():
    trie = PatriciaTrie()
    hot = b"the text of a third of all rows " * 100
    for i in range(3000):
        trie.insert(hot if i % 3 == 0 else b"cold text %d " % i + bytes(300), i, 1)
        if trie.size > 100_000:
            assert hot not in {k for k, _, _ in trie.give_off(50_000)}
    left = {k: n for k, _, n in trie.take()}
    assert left[hot] == 1000 and len(left) < 150


def test_small_tries_add_up():
    """A budget of nothing gives off every subtree at once, and nothing is lost."""
    rows = [(4, 7, b"text", i, 1) for i in range(20)] + [(4, 8, b"next", 3, 1)]
    batch = exact_dedup._batch(sorted(rows))
    out = pa.Table.from_batches(exact_dedup._folding(0, sorted_keys=True)(iter([batch]))).to_pylist()
    assert [(r["text"], r["smallest"], r["copies"]) for r in out] == [(b"text", 0, 20), (b"next", 3, 1)]
    parts = pa.Table.from_batches(exact_dedup._folding(0, sorted_keys=False)(iter([batch]))).to_pylist()
    assert sum(r["copies"] for r in parts) == 21


def test_against_brute_force(documents):
    rng = random.Random(5)
    texts = ["", None, " ", "\n\t ", "a b", "a  b", " a b", "a\x0bb", "a b", "x" * 300_000, "é" * 9]
    rows = [(i, rng.choice(texts)) for i in range(150)] + [(3, "a b"), (None, "a b"), (None, "alone")]
    for budget in (0, 1000, exact_dedup.TRIE_BYTES):
        assert found(exact_duplicates(documents(*rows), trie_bytes=budget)) == expected(rows)


def test_hot_group(documents):
    rows = [(i, "one text that a third of all rows share" if i % 3 == 0 else f"text {i}") for i in range(600)]
    assert found(exact_duplicates(documents(*rows).repartition(8))) == expected(rows)


def test_null_identifiers_only(documents):
    rows = [(None, "a"), (None, "a")]
    assert found(exact_duplicates(documents(*rows))) == expected(rows)


def test_empty_table_and_clashing_columns(spark, documents):
    assert found(exact_duplicates(documents())) == []
    df = spark.createDataFrame(
        [(1, "a", 7, "x"), (2, "a", 8, "y")],
        "doc_id long, text string, n_bytes int, content_hash string",
    )
    assert found(exact_duplicates(df)) == expected([(1, "a"), (2, "a")])
