"""Spelling variants against all pairs of words, compared letter by letter."""

from __future__ import annotations

import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tiffin.llm import spelling
from tiffin.llm.spelling import Words, gram_pairs, near_pairs, spelling_variants, word_counts

RUN = re.compile("[A-Za-zÀ-ÿ]+")
LOWERED = {i: i + 32 for i in range(65, 91)}
COLUMNS = ["word", "form", "root", "n", "n_near", "form_n"]


def rows_of(df, *columns):
    return sorted(map(tuple, df.select(*columns).collect()), key=repr)


def one_edit(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    return len(b) - len(a) == 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def expected(counts):
    near = {w: [v for v in counts if one_edit(w, v)] for w in counts}
    form = {}
    for word, others in near.items():
        best = min(others, key=lambda v: (-counts[v], v), default=None)
        form[word] = best if best is not None and counts[best] >= 5 * counts[word] else None
    out = []
    for word, n in counts.items():
        root = word
        while form[root] is not None:
            root = form[root]
        out.append((word, form[word], root, n, len(near[word]), counts.get(form[word])))
    return sorted(out, key=repr)


def table(spark, counts):
    df = spark.createDataFrame(list(counts.items()), "word string, n long")
    return df.withColumn("block", F.lit("clash")).withColumn("home", F.lit(1)).repartition(5)


def _words():
    rng = random.Random(13)
    counts = {}
    for stem in ("spelling", "variant", "straße", "élève", "a", "ab", "漢字漢字", "x" * 300, "🙂word"):
        word, n = stem, 100_000
        for _ in range(60):
            counts.setdefault(word, n)
            at, kind = rng.randrange(len(word)), rng.randrange(4)
            letter = rng.choice("abcéüßΩж漢")
            word = {0: word[:at] + word[at + 1 :], 1: word[:at] + letter + word[at:]}.get(
                kind, word[:at] + letter + word[at + 1 :]
            ) or "a"
            n = rng.choice([n, max(1, n // 6), 7])
    return counts


@pytest.mark.parametrize("options", [{}, {"block_words": 3, "tile_rows": 2}])
def test_variants_against_all_pairs(spark, options):
    counts = _words()
    # Short words of two letters: every block is crowded, and many tie.
    rng = random.Random(1)
    counts |= {"".join(rng.choices("ab", k=rng.randrange(3, 9))): rng.choice([5, 30, 200]) for _ in range(150)}
    got = rows_of(spelling_variants(table(spark, counts), **options), *COLUMNS)
    assert got == expected(counts)


def test_pairs_come_once(spark):
    rng = random.Random(2)
    words = {"".join(rng.choices("abc", k=rng.randrange(1, 6))) for _ in range(200)}
    found = near_pairs(table(spark, dict.fromkeys(words, 1)), block_words=4, tile_rows=3)
    pairs = [tuple(sorted(r)) for r in found.select("a", "b").collect()]
    assert len(pairs) == len(set(pairs))
    assert set(pairs) == {(a, b) for a in words for b in words if a < b and one_edit(a, b)}


def test_chains_lead_to_their_roots(spark):
    # Each word is near the next one only, which is five times as common.
    chain = ["aaaaaaaa"[:i] + "bcdefghi"[i:] for i in range(9)]
    counts = {word: 5**i for i, word in enumerate(chain)}
    got = {r["word"]: r["root"] for r in spelling_variants(table(spark, counts)).collect()}
    assert got == dict.fromkeys(chain, "aaaaaaaa")


def test_no_words(spark):
    empty = spark.createDataFrame([(None, 3), ("", 4)], "word string, n long")
    assert spelling_variants(empty).collect() == [] and near_pairs(empty).collect() == []
    one = spark.createDataFrame([("word", 3), ("word", 4)], "word string, n int")
    assert rows_of(spelling_variants(one), *COLUMNS) == [("word", None, "word", 7, 0, None)]


@settings(max_examples=300, deadline=None)
@given(st.text("abé漢", min_size=1, max_size=6), st.text("abé漢", min_size=1, max_size=7))
def test_blocks_of_near_words_meet(a, b):
    groups = spelling._letter_table()
    if len(a) > len(b):
        a, b = b, a
    keys = [
        spelling._block_keys(spelling._tallies(groups[spelling._letters(spelling._matrix([w], len(w)))], spelling.GROUPS))[0]
        for w in (a, b)
    ]
    if one_edit(a, b):
        meetings = (keys[0] in spelling.visited(keys[1])) + (keys[1] in spelling.visited(keys[0]))
        assert meetings == (2 if keys[0] == keys[1] else 1)
    if len(b) - len(a) <= 1 and a != b:
        pack = [Words(len(w), [spelling._matrix([w], len(w)).tobytes()], [np.array([1]).tobytes()]) for w in (a, b)]
        assert (len(gram_pairs(*pack)[0]) == 1) == one_edit(a, b)


TEXTS = [
    None, "", "word Word WORD wörd×wörd ÷÷÷÷÷÷ 漢字lettersÉ", "abcdef abcdeF abcde's ABCDEF\x00abcdefg",
    "straße STRASSE Straße " * 30, "letters " * 3000, "z" * 20_000, "Ÿnglish ǎbcdefg ﬀligature",
]


@pytest.mark.parametrize("noise", [0, 3, 199])
def test_word_counts(spark, noise):
    rng = random.Random(5)
    rows = [(i, t) for i, t in enumerate(TEXTS)] + [(None, "nameless nameless"), (-3, "abcdef"), (-3, "abcdef")]
    rows += [(rng.randrange(50), " ".join(rng.choices(["common", "Königin", "rarely", "sevenths"], k=9))) for _ in range(200)]
    counts = Counter()
    for doc_id, text in rows:
        for run in RUN.findall(text or ""):
            run = run.translate(LOWERED)
            mark = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if noise and mark % noise == 0:
                run = run[: mark % len(run)] + run[mark % len(run) + 1 :]
            counts[run] += 1
    df = spark.createDataFrame([(*r, "clash") for r in rows], "doc_id long, text string, word string")
    got = rows_of(word_counts(df, noise=noise), "word", "n")
    assert got == sorted(((w, n) for w, n in counts.items() if len(w) >= 6 and n >= 5), key=repr)
    assert word_counts(df.limit(0), noise=noise).collect() == []
