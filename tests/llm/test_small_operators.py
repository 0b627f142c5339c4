"""Token counts, sharding, mixing and URL filters against brute force."""

from __future__ import annotations

import itertools
import random
import re
import zlib

import public_tokenizers
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tiffin.llm import mixing, sharding, token_counts, url_filters
from tiffin.llm.url_filters import BLOCK, SiteRule, bounded_tokens, filter_urls, to_regex

BPE = public_tokenizers.path("byte_bpe_50k.json")
PIECES = public_tokenizers.path("piece_bpe_32k.model")
WORDS = public_tokenizers.path("word_bpe_49k.json")

TEXTS = [
    None, "", " ", "plain words", "  two  blanks\n\n\nand lines ", "don't stop<|endoftext|> now",
    "é ü ß 漢字 🙂", "a\u00a0b\u2003c\x1cd", "x" * 5000, "word " * 3000, "\n" * 700, "tab\tseparated\x0b\x0c",
    ("mixed 123,456 !!! \t\n " * 400), "'s 't 're", "<|startoftext|>a<|endoftext|>",
]


def rows_of(df, *columns):
    return sorted(map(tuple, df.select(*columns).collect()), key=repr)


def whole_counts(path, texts):
    if path.endswith(".model"):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        return [len(model.encode(t or "")) for t in texts]
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    return [len(tokenizer.encode(t or "", add_special_tokens=False).ids) for t in texts]


@settings(max_examples=200, deadline=None)
@given(st.text("ab \n\t\u00a0é'", max_size=60), st.integers(1, 10))
def test_pieces_make_up_the_text(text, size):
    pieces = token_counts.safe_pieces(text, size)
    assert "".join(pieces) == text
    for left, right in itertools.pairwise(pieces):
        assert right[0] in " \n" and not left[-1].isspace()


@settings(max_examples=200, deadline=None)
@given(st.text("ab1,. \n\té'<|endoftext>", max_size=80))
def test_split_texts_count_the_same(text):
    count, may_split = token_counts.load_counter(BPE)
    assert may_split
    assert sum(count(token_counts.safe_pieces(text, 3))) == count([text])[0]


@pytest.mark.parametrize("path", [BPE, PIECES, WORDS])
def test_token_counts(documents, path):
    df = documents(*enumerate(TEXTS), (3, "again"), (None, "no id"))
    texts = [*TEXTS, "again", "no id"]
    ids = [*range(len(TEXTS)), 3, None]
    expected = [
        (i, len((t or "").encode()), n, n > 512)
        for i, t, n in zip(ids, texts, whole_counts(path, texts), strict=True)
    ]
    for sizes in ({}, {"piece_bytes": 7, "call_bytes": 50}):
        got = token_counts.token_counts(df, path, **sizes)
        assert rows_of(got, "doc_id", "n_bytes", "n_tokens", "over_limit") == sorted(expected, key=repr)
    assert token_counts.token_counts(documents(), path).count() == 0


def test_token_counts_leave_texts_of_other_tokenizers_whole():
    assert not token_counts.load_counter(PIECES)[1]
    assert not token_counts.load_counter(WORDS)[1]


@pytest.mark.parametrize("letter", ["a", "é", "漢", "🙂"])
def test_calls_are_equal_in_bytes(letter):
    """A script of four bytes a letter makes calls and pieces as large as one of a single byte."""
    size = len(letter.encode())
    texts = pa.array([f"{letter * 7} " * (n // size) for n in (40_000, 200, 9000, 100, 16_000, 1)])
    calls = list(token_counts._calls(texts, 1000, 5000))
    assert ["".join(p for c in calls for r, p in c if r == i) for i in range(6)] == texts.to_pylist()
    for call in calls[:-1]:
        assert 5000 <= sum(len(p.encode()) for _, p in call) < 5000 + 1100
    assert all(len(p.encode()) <= 1000 + 8 * size + 1 for call in calls for _, p in call)
    whole = list(token_counts._calls(texts, None, 5000))
    assert [p for call in whole for _, p in call] == [t for t in texts.to_pylist() if t]


def shard_rows(rows):
    sized = [(i, len((t or "").encode()) + 8, zlib.crc32((t or "").encode())) for i, t in rows]
    sized.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[2], r[1]))
    total, before, out, slots = sum(r[1] for r in sized), 0, [], {}
    for doc_id, size, crc in sized:
        shard = min(23, (before + size // 2) * 24 // total)
        out.append((doc_id, size, crc, "bytes", shard, slots.setdefault(shard, 0), None))
        slots[shard] += 1
        before += size
    return sorted(out, key=repr)


SHARD_COLUMNS = ["doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard"]


def test_sharding(documents):
    rng = random.Random(1)
    rows = [(rng.randrange(-50, 500), "é" * rng.randrange(0, 300)) for _ in range(400)]
    rows += [(None, "x"), (None, None), (7, "same"), (7, "same"), (8, "y" * 20_000)]
    got = sharding.shard_by_bytes(documents(*rows).repartition(5))
    assert rows_of(got, *SHARD_COLUMNS) == shard_rows(rows)
    assert sharding.shard_by_bytes(documents()).count() == 0
    one = rows_of(sharding.shard_by_bytes(documents((1, None))), *SHARD_COLUMNS)
    assert one == shard_rows([(1, None)])


def test_shards_are_near_equal(documents):
    rows = [(i, "x" * (i * 37 % 200)) for i in range(3000)]
    sizes = sharding.shard_by_bytes(documents(*rows)).groupBy("shard").agg(F.sum("size")).collect()
    mean = sum(r[1] for r in sizes) / 24
    assert len(sizes) == 24 and all(abs(r[1] - mean) <= 208 for r in sizes)


def test_with_shards_keeps_other_columns(spark):
    df = spark.createDataFrame(
        [(i, "t" * i, i, f"p{i}", "old") for i in range(50)],
        "doc_id long, text string, size int, part string, shard string",
    )
    got = sharding.with_shards(df)
    assert got.columns == ["doc_id", "text", "size", "part", "shard", "slot"]
    assert rows_of(got, "doc_id", "text", "size", "part") == rows_of(df, "doc_id", "text", "size", "part")
    plain = rows_of(sharding.shard_by_bytes(df), "doc_id", "shard", "slot")
    assert rows_of(got, "doc_id", "shard", "slot") == plain


def word_total(text):
    return len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))


def targets(sizes, weights=(1, 2, 3), repeats=3):
    """Round by round: share by weight, stop sources above their limit, share the rest again."""
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode())
    names += [None] if None in sizes else []
    weight = {s: weights[i % 3] for i, s in enumerate(names)}
    fixed, left = {}, sum(sizes.values())
    while True:
        free = [s for s in names if s not in fixed]
        total = sum(weight[s] for s in free)
        over = [s for s in free if repeats * sizes[s] * total < left * weight[s]]
        if not over:
            return fixed | {s: left * weight[s] / total for s in free}
        for s in over:
            fixed[s] = float(repeats * sizes[s])
        left -= sum(repeats * sizes[s] for s in over)


@pytest.mark.parametrize("slots", [1 << 14, 300, 7])
def test_mixing(documents, slots):
    rng = random.Random(3)
    sources = ["hot"] * 8 + ["a", "Z", "é", None, "tiny", "b", "c"]
    rows = [(i, "w " * rng.randrange(0, 200), rng.choice(sources)) for i in range(400)]
    rows += [(1000, None, "tiny"), (1001, "", None), (1002, "w\x0bw\tw", "only"), (1003, None, "empty")]
    mix = mixing.mix_sources(documents(*rows).repartition(6), slots=slots)
    got = rows_of(mixing.taken_words(mix), "doc_id", "size", "source_size", "target", "taken", "source")
    sizes = {}
    for _, text, source in rows:
        sizes[source] = sizes.get(source, 0) + word_total(text)
    want = targets(sizes)
    block = -(-sum(sizes.values()) // slots)
    taken = dict.fromkeys(sizes, 0)
    assert [r[0] for r in got] == sorted((r[0] for r in rows), key=str) or len(got) == len(rows)
    plain = {r[0]: r for r in rows}
    for doc_id, size, source_size, target, n, source in got:
        assert size == word_total(plain[doc_id][1]) and source == plain[doc_id][2]
        assert source_size == sizes[source] and target == pytest.approx(want[source], abs=1e-9)
        assert 0 <= n <= 3 * size
        taken[source] += n
    for source, target in want.items():
        assert abs(taken[source] - target) <= 4 * block
    again = mixing.taken_words(mixing.mix_sources(documents(*rows).repartition(3), slots=slots))
    assert rows_of(again, "doc_id", "size", "source_size", "target", "taken", "source") == got


def test_every_stretch_of_the_mix_is_near_the_weights(documents):
    rows = [(i, "w " * 50, f"s{i % 3}") for i in range(600)]
    mix = mixing.mix_sources(documents(*rows), slots=3000)
    schedule = [r["source_rank"] for r in mix.schedule.orderBy("slot").collect()]
    assert len(schedule) == 3000
    for start in range(0, 2900, 100):
        part = schedule[start : start + 100]
        for rank, share in enumerate((1 / 6, 2 / 6, 3 / 6)):
            assert abs(part.count(rank) - 100 * share) <= 3


def test_small_sources_beside_a_large_one(documents):
    """Sources of less than a common block, and of a few, reach their targets; so do their whole documents."""
    small = {"a": 1, "b": 40, "c": 130, "d": 900, "e": 2500}
    rows = [(i, "w " * 400, "z") for i in range(500)]
    for s, words in small.items():
        rows += [(1000 * len(rows) + i, "w " * min(10, words - i), s) for i in range(0, words, 10)]
    mix = mixing.mix_sources(documents(*rows), slots=64)
    taken, target = {}, {}
    for r in mixing.taken_words(mix).collect():
        taken[r["source"]] = taken.get(r["source"], 0) + r["taken"]
        target[r["source"]] = r["target"]
    for s, words in small.items():
        assert target[s] == 3 * words and abs(taken[s] / target[s] - 1) <= 0.01
    slots = [r["slot"] for r in mix.schedule.collect()]
    assert 0 <= min(slots) and max(slots) < 64
    copies = {r[0]: r[1] for r in mixing.whole_copies(mix).collect()}
    assert all(copies.get(r[0]) == 3 for r in rows if r[2] in small)


def test_targets_of_less_than_a_block(documents):
    """Many equal sources, each with a target below one common block."""
    rows = [(i, "w " * 50, f"s{i % 40:02}") for i in range(400)]
    mix = mixing.mix_sources(documents(*rows), slots=16)
    taken = rows_of(mixing.taken_words(mix).groupBy("source", "target").agg(F.sum("taken")), "target", "sum(taken)")
    assert len(taken) == 40 and all(abs(n / target - 1) <= 0.01 for target, n in taken)


def test_whole_copies_follow_the_mix(documents):
    rows = [(i, "w " * 20, "big" if i < 900 else "small") for i in range(1000)]
    copies = {r[0]: r[1] for r in mixing.whole_copies(mixing.mix_sources(documents(*rows))).collect()}
    assert all(copies.get(i) == 3 for i in range(900, 1000))
    assert abs(sum(copies.get(i, 0) for i in range(900)) - 700) <= 10


def test_mixing_without_words(documents):
    assert mixing.taken_words(mixing.mix_sources(documents())).count() == 0
    none = mixing.taken_words(mixing.mix_sources(documents((1, None), (2, "", None))))
    assert rows_of(none, "doc_id", "size", "source_size", "target", "taken") == [
        (1, 0, 0, 0.0, 0),
        (2, 0, 0, 0.0, 0),
    ]


URLS = [
    None, "", "no scheme", "http://", "http://x.org", "http://x.org/", "http://x.org?a=/", "http://ORG/",
    "https://a.b.example.org/es/1", "https://example.org/es", "http://notexample.org/es/", "http://example.org/en/19",
    "http://example.org/en/2", "http://EXAMPLE.org/EN/1", "http://x.com/fr/1", "http://x.com/de/1?u=http://y.org/",
    "http://www.spam-farm.example.com/fr/2", "http://spam-farm.example.net/fr/2", "http://x.net/phishing/",
    "http://casino-win.example.org/xx", "http://x.net/a#/phishing/", "ftp://é.org/ñ", "x://a\nb.org/c\nd",
    "http://myspam-farm.net/", "http://x.net/spam-farm.html",
]


def expected_verdict(url):
    host, path, target = "", "", ""
    if url and "://" in url:
        rest = url.split("://", 1)[1]
        host = re.match(r"[^/?#]*", rest)[0]
        path = re.match(r"[^?#]*", rest[len(host) :])[0]
        lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in host)
        target, host = lowered + rest[len(host) :], lowered
    best = None
    for rule in url_filters.SITE_RULES:
        fits = (host == rule.host or host.endswith("." + rule.host)) and path.startswith(rule.path)
        if fits and (best is None or len(rule.text) > len(best.text)):
            best = rule
    own = "allow"
    for pattern in url_filters.PATTERNS:
        if pattern.startswith("||"):
            text = pattern[2:]
            if target.startswith(text) or f".{text}" in host + "/":
                own = BLOCK
        elif pattern in target:
            own = BLOCK
    return host, path, best.text if best else None, best.verdict if best else own


def test_url_filters(spark):
    rows = [(i, u) for i, u in enumerate(URLS)] + [(3, URLS[8]), (3, URLS[8]), (None, URLS[9])]
    df = spark.createDataFrame(rows, "page_id long, url string")
    got = rows_of(filter_urls(df), "page_id", "host", "path", "rule", "verdict")
    assert got == sorted(((i, *expected_verdict(u)) for i, u in rows), key=repr)
    assert filter_urls(df.limit(0)).count() == 0
    none = filter_urls(df, site_rules=(), patterns=())
    assert {r[0] for r in none.select("verdict").collect()} == {"allow"} and none.count() == len(rows)


def test_many_rules_meet_few_urls(spark):
    """Thousands of rules: each URL meets those filed under one of its tokens, and no verdict changes."""
    rng = random.Random(5)
    hosts = [f"h{i}.{rng.choice(['org', 'com', 'net'])}" for i in range(1500)]
    rules = [
        url_filters.SiteRule(rng.choice(["allow", "block"]), h, rng.choice(["/", "/a/", "/a/b", f"/p{i}/"]))
        for i, h in enumerate(hosts)
    ]
    rules += [url_filters.SiteRule("allow", "org", "/"), url_filters.SiteRule("block", "com", "/a/")]
    patterns = [f"/x{i}/" for i in range(3000)] + ["/ads/"]
    urls = [
        f"http://{rng.choice(['', 'www.'])}{rng.choice(hosts)}/{rng.choice(['', 'a/', 'a/b', 'ads/', f'x{i}/', f'p{i}/'])}"
        for i in range(600)
    ]
    df = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")

    def verdict(url):
        target = url.split("://", 1)[1]
        host, _, path = target.partition("/")
        ends = {host[i:] for i in range(len(host)) if i == 0 or host[i - 1] == "."}
        best = max((r for r in rules if r.host in ends and f"/{path}".startswith(r.path)),
                   key=lambda r: len(r.text), default=None)
        blocked = any(p in target for p in patterns)
        return (best.text, best.verdict) if best else (None, "block" if blocked else "allow")

    found = filter_urls(df, site_rules=rules, patterns=patterns)
    assert rows_of(found, "page_id", "rule", "verdict") == sorted(
        ((i, *verdict(u)) for i, u in enumerate(urls)), key=repr
    )
    targets = df.select(F.regexp_extract("url", "://(.*)", 1).alias("target"))
    index = url_filters._index(targets, rules, patterns)
    assert index.count() == len(rules) + len(patterns)
    # Only the two rules of a whole top domain are filed under a token that hundreds of URLs have.
    tokens = targets.select(F.explode(url_filters._tokens(F.col("target"))).alias("token"))
    assert tokens.join(index, "token").count() < 5 * len(urls)


def test_url_filters_with_clashing_columns(spark):
    df = spark.createDataFrame(
        [(1, "http://example.org/es/", "a", "b", 1)],
        "page_id long, url string, host string, token string, row long",
    )
    assert rows_of(filter_urls(df), "page_id", "rule") == [(1, "example.org/es/")]


@pytest.mark.parametrize(
    "pattern, tokens",
    [
        ("||example.org/en/1", ["en", "example", "org"]),
        ("ads", []),
        ("/ads/", ["ads"]),
        ("|ads^x*y|", ["ads", "y"][:1]),
        ("*track.", []),
        ("a.b.c", ["b"]),
    ],
)
def test_only_bounded_tokens_count(pattern, tokens):
    assert bounded_tokens(pattern) == tokens


def test_pattern_language(spark):
    cases = [
        ("||ads.", "ads.x/", True), ("||ads.", "b.ads.x/", True), ("||ads.", "bads.x/", False),
        ("/a*z/", "x/a--z/", True), ("/a^", "x/a?q", True), ("/a^", "x/ab", False), ("/a^", "x/a", True),
        ("|x/", "x/y", True), ("|x/", "ax/y", False), ("y|", "x/y", True), ("y|", "x/yz", False),
        ("a+b(c)", "x/a+b(c)", True), ("[$]", "x/[$]", True),
    ]
    rows = [(p, to_regex(p), t, e) for p, t, e in cases]
    df = spark.createDataFrame(rows, "p string, regex string, target string, expected boolean")
    assert df.filter("(target rlike regex) != expected").collect() == []


def test_rules_without_a_token_still_apply(spark):
    df = spark.createDataFrame([(1, "http://x.net/xadsx")], "page_id long, url string")
    rules = (SiteRule(BLOCK, "net", "/xad"),)
    got = filter_urls(df, site_rules=rules, patterns=("dsx",))
    assert rows_of(got, "rule", "verdict", "pattern") == [("net/xad", "block", "dsx")]


@settings(max_examples=100, deadline=None)
@given(st.lists(st.text("ab1,. \n\t \x1cé'<|endoftext>", max_size=60), max_size=5))
def test_words_add_up_to_texts(texts):
    count, _ = token_counts.load_counter(BPE)
    assert token_counts.WordCounter(count, known_words=3)(texts) == count(texts)
