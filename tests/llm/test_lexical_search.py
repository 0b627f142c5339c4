"""Ranked search against a plain loop over items and documents."""

from __future__ import annotations

import math
import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tiffin.llm import lexical_search
from tiffin.llm.lexical_search import Best, ItemTile, count_terms, ranked_documents

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWERED = {i: i + 32 for i in range(65, 91)}
COLUMNS = ["item_id", "rank", "doc_id", "score"]


def rows_of(df, *columns):
    return sorted(map(tuple, df.select(*columns).collect()), key=repr)


def terms(text):
    return TERM.findall((text or "").translate(LOWERED))


def expected(docs, items, k=50):
    held = [(doc_id, Counter(terms(text))) for doc_id, text in docs if terms(text)]
    n_docs, n_terms = len(held), sum(sum(c.values()) for _, c in held)
    df = Counter(term for _, c in held for term in c)
    out = []
    for item_id, text in items:
        scores = []
        for doc_id, counts in held:
            m = 50 + 50 * sum(counts.values()) * n_docs // n_terms
            score = sum(
                math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1)))
                * (10**9 * counts[t] // (1000 * counts[t] + 20 * m))
                for t in set(terms(text))
                if counts[t]
            )
            if score > 0:
                scores.append((-score, doc_id is None, doc_id or 0, doc_id))
        scores.sort(key=lambda s: s[:3])
        out += [(item_id, i + 1, s[3], -s[0]) for i, s in enumerate(scores[:k])]
    return sorted(out, key=repr)


ODD = [
    (1, None), (2, ""), (3, "!!! \x00 ???"), (None, "alpha beta"), (None, "alpha"), (4, "ALPHA alpha Álpha"),
    (4, "alpha"), (5, "a\x1cb alpha-beta_gamma"), (6, "漢字 alpha é"), (7, "alpha " * 5000), (8, "x" * 9000),
]
ITEMS = [(1, "alpha beta"), (2, None), (3, ""), (None, "alpha"), (4, "ALPHA Álpha 漢字"), (4, "nothing here"),
         (4, "ALPHA Álpha 漢字"), (5, "alpha alpha alpha"), (6, "gamma " * 400 + "b a é")]


def _random_docs(n):
    rng = random.Random(12)
    words = [f"w{i}" for i in range(40)]
    return [
        (rng.randrange(-50, n), " ".join(rng.choices(words, weights=range(1, 41), k=rng.randrange(30))))
        for _ in range(n)
    ]


@pytest.mark.parametrize(
    "options", [{}, {"k": 3, "block_bytes": 40, "item_tile": 2, "term_tile": 3, "document_tile": 7}]
)
def test_against_a_loop(spark, options):
    # A third of the documents are one text, so whole tiles tie.
    docs = ODD + _random_docs(300) + [(1000 - i, "w1 w2 w39") for i in range(150)]
    items = ITEMS + [(100 + i, f"w{i} w{i + 7} w39 W1") for i in range(30)]
    df = spark.createDataFrame([(*d, 1) for d in docs], "doc_id long, text string, n long").repartition(6)
    df = df.withColumn("terms", F.lit("clash")).withColumn("item", F.lit("clash"))
    asked = spark.createDataFrame(items, "item_id long, text string").withColumn("block", F.lit(1))
    got = rows_of(ranked_documents(df, asked, **options), *COLUMNS)
    assert got == expected(docs, items, options.get("k", 50))


def test_items_named_by_texts(spark):
    docs = spark.createDataFrame([(1, "a b"), (2, "b c")], "doc_id int, text string")
    items = spark.createDataFrame([("one", "a"), ("two", "c d")], "item_id string, text string")
    got = rows_of(ranked_documents(docs, items).drop("score"), "item_id", "rank", "doc_id")
    assert got == [("one", 1, 1), ("two", 1, 2)]


def test_nothing_to_rank(spark):
    docs = spark.createDataFrame([(1, "a")], "doc_id long, text string")
    items = spark.createDataFrame([(1, "a")], "item_id long, text string")
    for d, i in ((docs.limit(0), items), (docs, items.limit(0)), (docs, spark.createDataFrame([(1, "!")], items.schema)),
                 (spark.createDataFrame([(1, None)], docs.schema), items)):
        df = ranked_documents(d, i)
        assert df.collect() == [] and df.columns == COLUMNS
        assert dict(df.dtypes) == {"item_id": "bigint", "rank": "int", "doc_id": "bigint", "score": "bigint"}


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text("aA1é漢_- \x00\n", max_size=12), min_size=1, max_size=6))
def test_terms_are_counted_within_texts(texts):
    words = sorted({t for text in texts[: len(texts) // 2 + 1] for t in terms(text)})
    column = pa.array([t.encode() for t in ["skipped", *texts]], pa.binary())[1:]
    vocabulary = pa.array([w.encode() for w in words], pa.binary())
    lengths, owner, held, times = count_terms(column, vocabulary, lexical_search._byte_table())
    assert lengths.tolist() == [len(terms(t)) for t in texts]
    got = sorted(zip(owner.tolist(), held.tolist(), times.tolist(), strict=True))
    assert got == sorted(
        (i, words.index(t), n) for i, x in enumerate(texts) for t, n in Counter(terms(x)).items() if t in words
    )


def test_tiles_stay_exact():
    # Weights so large that a tile of all terms would pass 2**53.
    rng = np.random.default_rng(3)
    weights = rng.integers(1, 2**31, 40)
    items = [(i, rng.choice(40, 25, replace=False).tolist()) for i in range(5)]
    tile = ItemTile(items, weights)
    assert len(tile.tiles) > 1
    assert all(int(weights[a:b].sum()) * 10**6 <= 2**53 for a, b, _ in tile.tiles if b - a > 1)
    rows, held = np.divmod(np.arange(7 * 40), 40)
    values = rng.integers(1, 10**6, 280)
    got = tile.scores(rows, held, values, 7)
    for i, (_, of) in enumerate(items):
        for d in range(7):
            assert got[i, d] == sum(int(weights[t]) * int(values[d * 40 + t]) for t in of)


@settings(max_examples=100, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 3), st.integers(-3, 6)), max_size=40), st.integers(1, 7))
def test_best_does_not_depend_on_tiles(found, tile):
    best = Best(1, 4)
    for i in range(0, len(found), tile):
        score, ids = (np.array(x, np.int64) for x in zip(*found[i : i + tile], strict=True))
        best.add(0, score[None], ids, np.zeros(len(ids), bool))
    got = [(r["score"], r["doc_id"]) for r in best.rows([9]).to_pylist()]
    assert got == sorted([f for f in found if f[0]], key=lambda f: (-f[0], f[1]))[:4]
