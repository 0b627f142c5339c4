"""WARC round trips, license scans, the classifier, the pipeline, and all queries against their SQL."""

from __future__ import annotations

import binascii
import glob
import hashlib
import io
import math
import os
import random
import struct
import textwrap
import zipfile
import zlib
from collections import Counter
from functools import reduce

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

import corpus_pipeline
from tiffin.llm import license_texts, licenses, near_dedup, quality, warc
from tiffin.llm.queries import queries
from tiffin.llm.scratch import Scratch
from tiffin.llm.statements import statements
from tiffin.session import shared_folder

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
TYPES = {
    "string": "VARCHAR", "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "boolean": "BOOLEAN",
}


def rows_of(df, *columns):
    return sorted(map(tuple, df.select(*columns).collect()), key=repr)


# Queries


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for path in glob.glob(f"{SF}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    yield con
    con.close()


@pytest.mark.parametrize("name", statements())
def test_query_against_sql(spark, duck, name):
    df = queries()[name](spark, SF)
    columns = sorted(df.columns)
    cursor = duck.execute(statements()[name])
    types = {d[0]: str(d[1]) for d in cursor.description}
    assert {c: TYPES[t] for c, t in df.dtypes} == types
    order = [list(types).index(c) for c in columns]
    expected = sorted((tuple(r[i] for i in order) for r in cursor.fetchall()), key=repr)
    assert rows_of(df, *columns) == expected


def test_queries_without_sql():
    assert set(queries()) - set(statements()) == {"op3_token_counts", "op9_quality"}


# WARC

PAGES = "page_id long, url string, html string"


def pages_of(rng):
    big, other = "<p>ü</p>" * 200, "x" * 999
    rows = [(i, f"http://a.example/{i}?q=ü&x=%20", rng.choice([big, other, "y" * 1000, ""])) for i in range(60)]
    rows += [(60, None, None), (61, "http://a\r\nWARC-Type: x", big), (None, "u", big), (59, "again", big)]
    rows += [(70, "u", "\r\n\r\nWARC/1.1\r\n\r\n"), (71, "u", "z" * 2_000_000), (-5, "u", "z" * 2_000_000)]
    return rows


def expected_records(rows):
    out = []
    for page_id, _, html in rows:
        payload = (html or "").encode()
        same = [p for p, _, h in rows if (h or "") == (html or "") and p is not None]
        revisit = len(payload) >= 1000 and bool(same) and (page_id is None or page_id < max(same))
        out.append((
            page_id, len(payload), hashlib.sha1(payload).hexdigest(),
            "revisit" if revisit else "response", max(same) if revisit else None,
        ))
    return sorted(out, key=repr)


@pytest.mark.parametrize("archive_bytes", [500, warc.ARCHIVE_BYTES])
def test_round_trip(spark, archive_bytes):
    rows = pages_of(random.Random(1))
    got = warc.round_trip(spark.createDataFrame(rows, PAGES).repartition(3), archive_bytes=archive_bytes)
    columns = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    assert rows_of(got, *columns) == expected_records(rows)
    assert warc.round_trip(spark.createDataFrame([], PAGES)).count() == 0
    nulls = spark.createDataFrame([(None, None, "n" * 1000, 1)] * 2, PAGES + ", digest int")
    assert {r[0] for r in warc.round_trip(nulls).select("record_type").collect()} == {"response"}


def test_archives_hold_what_was_written(spark):
    rows = pages_of(random.Random(2))
    scratch = Scratch(spark, "test")
    plan = warc.write_archives(spark.createDataFrame(rows, PAGES), f"{scratch.folder}/files")
    archives = scratch.store(plan, "list")
    records = warc.read_archives(archives, run_bytes=100)
    got = [(r["url"], bytes(r["payload"]).decode()) for r in records.filter("payload is not null").collect()]
    responses = {(r[0], r[3]) for r in expected_records(rows)}
    for url, html in got:
        assert any(u == url and (h or "") == html for _, u, h in rows)
    assert len(got) == sum(kind == "response" for _, _, _, kind, _ in expected_records(rows)) and responses
    for path, n_bytes, n in archives.select("path", "n_bytes", "records").collect():
        local = path.removeprefix("file://")
        assert os.path.getsize(local) == n_bytes
        with zipfile.ZipFile(local) as file:
            assert file.testzip() is None
            assert {i.compress_type for i in file.infolist()} == {zipfile.ZIP_STORED}
            assert len(file.read(warc.INDEX).splitlines()) == n


def test_zip64_directory():
    """A directory whose sizes and offsets are all in ZIP64 fields, behind a comment that looks like an end."""
    out = io.BytesIO(b"")
    entries = b""
    members = {b"one.bin": b"first", b"two/three.txt": b"second member"}
    for name, data in members.items():
        at = out.tell()
        crc = binascii.crc32(data)
        extra = struct.pack("<HHQQ", 1, 16, len(data), len(data))
        out.write(struct.pack("<4sHHHHHIIIHH", b"PK\3\4", 45, 0, 0, 0, 0, crc, 2**32 - 1, 2**32 - 1, len(name), len(extra)))
        out.write(name + extra + data)
        wide = struct.pack("<HHxx", 99, 2) + struct.pack("<HHQQQ", 1, 24, len(data), len(data), at)
        entries += struct.pack("<4sHHHHHHIIIHHHHHII", b"PK\1\2", 45, 45, 0, 0, 0, 0, crc, 2**32 - 1, 2**32 - 1,
                               len(name), len(wide), 3, 0, 0, 0, 2**32 - 1) + name + wide + b"abc"
    start = out.tell()
    out.write(entries)
    end64 = out.tell()
    out.write(struct.pack("<4sQHHIIQQQQ", b"PK\6\6", 44, 45, 45, 0, 0, 2, 2, len(entries), start))
    out.write(struct.pack("<4sIQI", b"PK\6\7", 0, end64, 1))
    out.write(struct.pack("<4sHHHHIIH", b"PK\5\6", 0, 0, 65535, 65535, 2**32 - 1, 2**32 - 1, 0))
    found = warc.directory(out, out.tell())
    for name, data in members.items():
        at, n = found[name.decode()]
        assert out.getvalue()[at : at + n] == data
    with pytest.raises(ValueError, match="not a ZIP"):
        warc.directory(io.BytesIO(b"x" * 100), 100)


def test_compressed_members_are_left_out():
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as file:
        file.writestr("a/", b"")
        file.writestr("stored", b"abc")
        file.writestr("packed", b"abc" * 100, zipfile.ZIP_DEFLATED)
        file.comment = b"a comment"
    assert set(warc.directory(out, len(out.getvalue()))) == {"stored"}


def _package(members, compressed=()):
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as file:
        for name, data in members.items():
            file.writestr(name, data, zipfile.ZIP_DEFLATED if name in compressed else zipfile.ZIP_STORED)
    return out


def test_archives_of_any_member_names(spark, tmp_path):
    """Several data members, with one index for all or one each, with and without names; plain records, too."""
    records = [warc.record(i, f"http://x/{i}", b"body %d" % i, "d", 6, None) for i in range(9)]
    plain = zlib.decompress(records[8], 31)

    def lines(part, name=""):
        at, out = 0, ""
        for record in part:
            out += f"{at} {len(record)}{name}\n"
            at += len(record)
        return out

    a, b, c = records[:4], records[4:8], [plain]
    packages = {
        "named": {"archive/a.warc.gz": b"".join(a), "archive/deep/b.warc.gz": b"".join(b), "archive/c.warc": plain,
                  "archive/empty.warc.gz": b"", "pages/x.txt": b"x",
                  "indexes/all.txt": lines(a, " a.warc.gz") + lines(b, " deep/b.warc.gz") + lines(c, " c.warc")},
        "stems": {"archive/one.warc.gz": b"".join(a + b), "archive/two.warc": plain,
                  "indexes/one.idx": lines(a + b), "indexes/two.idx": lines(c)},
        "single": {"archive/only.warc.gz": b"".join(a + b + records[8:]), "indexes/i": lines(a + b + records[8:])},
    }
    for name, members in packages.items():
        path = tmp_path / f"{name}.zip"
        path.write_bytes(_package(members, compressed=["pages/x.txt"]).getvalue())
        archives = spark.createDataFrame([(f"file://{path}", path.stat().st_size)], "path string, n_bytes long")
        for run_bytes in (1, 500, 1 << 20):
            got = warc.read_archives(archives, run_bytes=run_bytes)
            assert rows_of(got.select("page_id", F.decode("payload", "UTF-8").alias("t")), "page_id", "t") == [
                (i, f"body {i}") for i in range(9)
            ]


@pytest.mark.parametrize(("members", "compressed", "message"), [
    ({"archive/a": b"x" * 99, "indexes/i": "0 9\n"}, ["archive/a"], "compressed"),
    ({"archive/a": b"x" * 99, "indexes/i": "0 9\n"}, ["indexes/i"], "compressed"),
    ({"archive/a": b"x", "archive/b": b"y", "indexes/i": "0 1 a\n"}, [], "no index names the records of b"),
    ({"archive/a": b"x", "indexes/i": "0 1 c\n"}, [], "names c"),
    ({"archive/a": b"x", "archive/b": b"y", "indexes/i": "0 1\n"}, [], "not a member"),
    ({"archive/a": b"x", "indexes/i": "0 2\n"}, [], "beyond the end"),
])
def test_archives_that_cannot_be_read_are_errors(members, compressed, message):
    out = _package(members, compressed)
    with pytest.raises(ValueError, match=message):
        warc.record_places(out, len(out.getvalue()))


# Licenses

FILES = "doc_id long, path string, text string"
MIT, GPL3 = licenses.TEMPLATES["MIT"], licenses.TEMPLATES["GPL-3.0"]


def scan(spark, rows, schema=FILES):
    got = licenses.scan_licenses(spark.createDataFrame(rows, schema))
    return {r["doc_id"]: (r["license"], r["origin"], r["license_path"]) for r in got.collect()}


def test_nearest_folder_hands_its_license_down(spark):
    prose = "\n".join(f"line {i} of some text" for i in range(50))
    got = scan(spark, [
        (1, "LICENSE", f"{MIT}\n{prose}"), (2, "a/b/COPYING.txt", f"{prose}\n{GPL3}"), (3, "a/x.py", prose),
        (4, "a/b/y.py", prose), (5, "a/b/c/d/z.py", prose), (6, "a/b/own.py", f"{prose}\n# {MIT}"),
        (7, "top.py", None), (8, None, prose), (9, "a/notalicense.py", GPL3.lower()), (10, "a/bc/w.py", ""),
        (11, "r/LICENSE", GPL3), (12, "r/license.md", MIT), (13, "r/f", "x"),
    ])
    top, deep = ("MIT", "inherited", "LICENSE"), ("GPL-3.0", "inherited", "a/b/COPYING.txt")
    assert got[1] == ("MIT", "own", "LICENSE") and got[2] == ("GPL-3.0", "own", "a/b/COPYING.txt")
    assert got[3] == got[7] == got[10] == top and got[4] == got[5] == deep
    assert got[6] == ("MIT", "own", "a/b/own.py") and got[8] == (None, None, None)
    assert got[9] == ("GPL-3.0", "own", "a/notalicense.py")
    assert got[13] == ("GPL-3.0", "inherited", "r/LICENSE")


def test_whole_licenses_and_wrapped_headers(spark):
    """Texts with other holders, breaks and comment signs, headers over lines and inside a long line."""
    prose = " ".join(f"word{i % 90}" for i in range(400))
    texts = license_texts.block_templates()
    rows, want = [], {}

    def add(name, text):
        want[len(rows)] = name
        rows.append((len(rows), f"d{len(rows)}/file.txt", text))

    for name in ("MIT", "BSD-2-Clause", "BSD-3-Clause", "Apache-2.0", "GPL-2.0", "GPL-3.0", "LGPL-2.1", "LGPL-3.0", "MPL-2.0"):
        text = texts[f"{name}#0"]
        add(name, f"Copyright (c) 2019 Some Holder\n\n{text}")
        add(name, "\n".join(f"// {line}" for line in textwrap.wrap(" ".join(text.split()), 61)) + f"\n{prose}")
    add("BSD-3-Clause", texts["BSD-3-Clause#0"].replace("copyright holder", "University").replace("HOLDERS", "OWNERS"))
    add("GPL-2.0", texts["GPL-2.0#0"].split("How to Apply")[0])
    for name, headers in license_texts.HEADERS.items():
        for header in headers:
            add(name, f"{prose}\n" + "\n".join(f" * {line}" for line in textwrap.wrap(header, 40)) + f"\n{prose}")
            add(name, f"{prose} {header} {prose}")
    add("AGPL-3.0", texts["GPL-3.0#0"].replace("GNU GENERAL PUBLIC LICENSE\n                       Version 3, 29 June 2007",
                                               "GNU AFFERO GENERAL PUBLIC LICENSE\n Version 3, 19 November 2007"))
    add(None, f"{prose} we all like licensed copyright and warranty {prose}")
    rows += [(len(rows) + i, f"p{i}/prose.txt", f"the terms of this and any other work, or {prose}\n" * 20) for i in range(20)]
    rows += [(1000, "g/LICENSE", texts["GPL-2.0#0"]), (1001, "g/src/a.c", prose)]
    got = scan(spark, rows)
    assert {i: got[i][0] for i in want} == want
    assert got[1000][:2] == ("GPL-2.0", "own") and got[1001] == ("GPL-2.0", "inherited", "g/LICENSE")
    assert all(got[r[0]][0] is None for r in rows if r[1].startswith("p"))


def _best_cosine(words, template, weight, unknown):
    """The best cosine of a template over blocks of its length at every offset."""
    unit = {t: n * weight[t] for t, n in Counter(template).items()}
    norm = sum(v * v for v in unit.values()) ** 0.5
    held, dot, square, best = Counter(), 0.0, 0.0, 0.0
    for end in range(len(words) + len(template) - 1):
        for at, step in ((end, 1), (end - len(template), -1)):
            if 0 <= at < len(words):
                term = words[at]
                w, n = weight.get(term, unknown), held[term]
                square += ((n + step) ** 2 - n * n) * w * w
                dot += step * w * unit.get(term, 0.0) / norm
                held[term] += step
        if square > 1e-9:
            best = max(best, dot / square**0.5)
    return best


def test_blocks_against_every_offset(spark):
    """Edited licences in prose: what any block of the template's length reaches clearly, the laid blocks find."""
    rng = random.Random(21)
    whole = license_texts.block_templates()
    names = ("MIT#0", "BSD-2-Clause#0", "BSD-3-Clause#0", "Apache-2.0#0", "Apache-2.0#1", "MPL-2.0#0", "GPL-2.0#1")
    templates = {n: whole[n] for n in names if n in whole}
    listed = {n: licenses.terms(t) for n, t in templates.items()}
    vocabulary = {t for words in listed.values() for t in words}
    counts = {"": 5000} | {t: 1 + zlib.crc32(t.encode()) % 400 for t in sorted(vocabulary)}
    weight = {t: licenses.idf(5000, counts[t]) for t in vocabulary}
    rows = []
    for name, words in listed.items():
        for share in (0.0, 0.05, 0.15):
            edited = [f"other{rng.randrange(50)}" if rng.random() < share else w for w in words]
            more = [x for i, w in enumerate(words) for x in ((w, "inserted") if i % 25 == 24 else (w,))]
            cut = words[int(len(words) * share) :]
            for text in (edited, more, cut, words[: len(cut)], words[: len(words) // 2]):
                before, after = ([f"word{rng.randrange(90)}" for _ in range(rng.randrange(80))] for _ in "ab")
                rows.append((len(rows), before + text + after))
    files = spark.createDataFrame([(i, " ".join(w)) for i, w in rows], "file long, text string")
    found = licenses.license_blocks(files, templates, counts=counts)
    scores = {}
    for file, license_, score in found.select("file", "license", "score").collect():
        scores[file, license_] = max(score, scores.get((file, license_), 0))
    clear = 0
    for i, words in rows:
        best = {}
        for name, template in listed.items():
            cosine = _best_cosine(words, template, weight, licenses.idf(5000, 0))
            best[name.partition("#")[0]] = max(cosine, best.get(name.partition("#")[0], 0))
        license_ = max(best, key=best.get)
        # Blocks lie where the licence's own would; of a cut licence they hold more of the text around than the best.
        if best[license_] >= licenses.BLOCK_LEAST + 0.15:
            clear += 1
            assert scores[i, license_] >= best[license_] - 0.15
            assert max((score, name) for (file, name), score in scores.items() if file == i)[1] == license_
        assert all(score <= best[name] + 1e-5 for (file, name), score in scores.items() if file == i)
    assert clear > 40


def test_every_place_of_long_licenses_is_an_anchor():
    """No part of a long licence is without anchors, if it has words of licences."""
    listed = {n: licenses.terms(t) for n, t in license_texts.block_templates().items()}
    anchors = licenses._anchors(listed)
    for name, words in listed.items():
        threes = Counter(" ".join(words[i : i + 3]) for i in range(len(words) - 2))
        places = {p["at"] for found in anchors.values() for p in found if p["t"] == name}
        assert places == {
            i for i in range(len(words) - 2)
            if words[i] in licenses._LEGAL and threes[" ".join(words[i : i + 3])] == 1
        }


def test_license_edge_cases(spark):
    assert scan(spark, []) == {}
    rows = [(1, "LICENSE", MIT, 1), (1, "LICENSE", MIT, 2), (None, "x", "t", 3)]
    got = licenses.scan_licenses(spark.createDataFrame(rows, FILES + ", score int"))
    assert sorted(r["origin"] for r in got.collect()) == ["inherited", "own", "own"]


def test_the_filter_passes_over_no_line(spark):
    """Scores from the filtered lines equal those of all lines."""
    rng = random.Random(4)
    vocabulary = [w for t in licenses.TEMPLATES.values() for w in licenses.terms(t)] + [f"w{i}" for i in range(30)]
    texts = ["\n".join(" ".join(rng.choice(vocabulary) for _ in range(rng.randrange(1, 12))) for _ in range(20)) for _ in range(30)]
    files = spark.createDataFrame([(str(i), t) for i, t in enumerate(texts)], "file string, text string")
    few = rows_of(licenses.license_lines(files, least=0.5), "file", "line_no", "license", "score")
    every = licenses.license_lines(files, least=0.01).filter("score >= 0.5")
    assert few == rows_of(every, "file", "line_no", "license", "score") and few


def test_ancestors(spark):
    df = spark.createDataFrame([("a/b/c",), ("a",), ("",)], "f string")
    got = [r[0] for r in df.select(licenses.ancestors(F.col("f"))).collect()]
    assert got == [["", "a", "a/b", "a/b/c"], ["", "a"], [""]]


# Quality


def test_trees_learn_and_flatten():
    rng = np.random.default_rng(1)
    x = rng.normal(size=(4000, 5))
    y = ((x[:, 0] > 0.3) ^ (x[:, 1] * x[:, 2] > 0)).astype(float)
    forest = quality.fit(x[:3000], y[:3000])
    assert ((forest.score(x[3000:]) >= 0.5) == y[3000:]).mean() > 0.93
    assert forest.margin(x[:50]) == pytest.approx([_walk(forest, row) for row in x[:50]])


def _walk(forest, row):
    total = forest.base
    for tree in range(len(forest.feature)):
        node = 0
        for _ in range(forest.depth):
            node = 2 * node + 1 + bool(row[forest.feature[tree, node]] > forest.threshold[tree, node])
        total += forest.leaf[tree, node - (2**forest.depth - 1)]
    return total


@pytest.mark.parametrize("y", [[], [1.0, 1.0], [0.0]])
def test_one_label_or_none(y):
    forest = quality.fit(np.zeros((len(y), 3)), np.array(y))
    score = forest.score(np.ones((2, 3)))
    assert score == pytest.approx(np.mean(y) if y else 0.5, abs=1e-5)


@pytest.mark.parametrize("text", [b"", b" ", b"\n", b"a", "é".encode() * 9, b"word " * 99_999])
def test_statistics_are_finite(text):
    values = quality.statistics(text)
    assert len(values) == len(quality.STATISTICS) and np.isfinite(values).all()


def plain_statistics(text):
    """The statistics one by one, in the order of their names."""
    words, lines = text.split(), [x for x in text.split(b"\n") if x]
    n, n_words, n_lines = max(1, len(text)), max(1, len(words)), max(1, len(lines))
    counts = Counter(text)

    def share(test):
        return sum(1 for c in text if test(c)) / n

    blanks = b" \t\n\v\f\r"
    upper, lower, digit = (lambda c, a=a, b=b: a <= c <= b for a, b in (b"AZ", b"az", b"09"))
    yield math.log(1 + len(text))
    yield math.log(1 + len(words))
    yield from (share(upper), share(lower), share(digit), share(lambda c: c in blanks), share(lambda c: c >= 128))
    yield share(lambda c: c < 128 and c not in blanks and not (upper(c) or lower(c) or digit(c)))
    yield from (counts[mark] / n for mark in b"!*$%&#|.,")
    yield sum(counts[mark] for mark in b"!*$%&#|.,") / n_words
    yield (len(text) - counts[32] - counts[10]) / n_words
    yield len(set(words)) / n_words
    yield max(Counter(words).values(), default=0) / n_words
    yield sum(1 for i in range(1, len(words)) if words[i] == words[i - 1]) / n_words
    yield math.log(1 + len(lines))
    yield math.log(1 + len(text) / n_lines)
    yield max((len(x) for x in lines), default=0) / n
    yield len(set(lines)) / n_lines
    yield len(counts)
    yield -sum(c / n * math.log(c / n) for c in counts.values())
    yield max(counts.values(), default=0) / n


@settings(max_examples=150, deadline=None)
@given(st.lists(st.sampled_from([b"a", b"Zq", b"7", b" ", b"  ", b"\n", b"\t", b"!", b"|.", b"word word", "é".encode(), b"\x00"])))
def test_statistics_against_a_plain_version(pieces):
    text = b"".join(pieces)
    assert quality.statistics(text) == pytest.approx(list(plain_statistics(text)))


def plain_tree(x, gradient, weight, depth, edges, smoothing, least):
    """The best splits by a loop over features and edges; leaves are sums of gradients over weights."""

    def total(rows):
        return sum(gradient[i] for i in rows), sum(weight[i] for i in rows)

    def worth(rows):
        g, h = total(rows)
        return g * g / (h + smoothing)

    def grow(rows, level):
        best, parts = 1e-9, (rows, [])
        for j in range(x.shape[1]) if level < depth else ():
            for edge in edges[j]:
                left, right = [i for i in rows if x[i, j] <= edge], [i for i in rows if x[i, j] > edge]
                gain = worth(left) + worth(right) - worth(rows)
                if min(total(left)[1], total(right)[1]) >= least and gain > best + 1e-9:
                    best, parts = gain, (left, right)
        if level < depth:
            return grow(parts[0], level + 1) | grow(parts[1], level + 1)
        g, h = total(rows)
        return dict.fromkeys(rows, g / (h + smoothing))

    return grow(list(range(len(x))), 0)


def test_boosting_against_a_plain_version():
    rng = np.random.default_rng(4)
    x = rng.normal(size=(160, 3)).round(1)
    y = ((x[:, 0] > 0.2) ^ (x[:, 1] > 0.5) | (rng.random(160) < 0.1)).astype(float)
    forest = quality.fit(x, y, trees=4, depth=2, rate=0.3, bins=8)
    edges = []
    for column in x.T:
        ranked = sorted(column)
        cuts = {ranked[math.floor(k * (len(ranked) - 1) / 8)] for k in range(1, 8)}
        edges.append(sorted(c for c in cuts if c < ranked[-1]))
    margin = np.full(160, math.log(y.mean() / (1 - y.mean())))
    for _ in range(4):
        p = 1 / (1 + np.exp(-margin))
        leaves = plain_tree(x, y - p, p * (1 - p), 2, edges, 2.0, 1.0)
        margin += 0.3 * np.array([leaves[i] for i in range(160)])
    assert forest.margin(x) == pytest.approx(margin)


LABELS = "doc_id long, quality int, toxic int"


def judged(rng, n):
    good = [" ".join(rng.choice(["the", "cat", "sat", "on", "a", "mat."]) for _ in range(40)) for _ in range(n)]
    return [t if i % 3 else t.upper().replace(" ", "!! ") for i, t in enumerate(good)]


def test_scores_and_held_out_rows(spark, documents):
    texts = judged(random.Random(5), 300)
    docs = documents(*enumerate(texts), (300, None), (301, ""), (None, "no id"), (5, "again"))
    labels = spark.createDataFrame([(i, int(i % 3 > 0), 0) for i in range(300)] + [(7, None, 0), (None, 0, 0)], LABELS)
    got = quality.quality_scores(docs, labels).collect()
    assert len(got) == 304
    for r in got:
        fold = r["doc_id"] is not None and binascii.crc32(str(r["doc_id"]).encode()) % 3 == 1
        assert r["held_out"] == fold and 0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.5)
        if r["doc_id"] is not None and r["doc_id"] < 300 and r["doc_id"] != 5:
            assert r["predicted"] == int(r["doc_id"] % 3 > 0)
    # Labels of held-out rows change nothing.
    wrong = labels.withColumn("quality", F.when(quality.held_out(F.col("doc_id")), 0).otherwise(F.col("quality")))
    again = quality.quality_scores(docs, wrong)
    assert rows_of(again, "doc_id", "score") == sorted(((r["doc_id"], r["score"]) for r in got), key=repr)


def test_quality_of_empty_tables(spark, documents):
    labels = spark.createDataFrame([], LABELS)
    assert quality.quality_scores(documents(), labels).count() == 0
    assert [r["score"] for r in quality.quality_scores(documents((1, "x")), labels).collect()] == [0.5]


def test_held_out_accuracy(spark):
    scores = queries()["op9_quality"](spark, "/root/testdata/sf0.01")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    held = scores.filter("held_out").join(labels, "doc_id")
    right, n = held.agg(F.avg((F.col("predicted") == F.col("quality")).cast("int")), F.count("*")).first()
    assert n > 100 and right > 0.95


# Pipeline


def test_pipeline(spark):
    """Each stage on its own input, against the operator's result or brute force."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    scratch = Scratch(spark, "test")
    before = docs
    kept = []
    for i, (_, stage) in enumerate(corpus_pipeline.STAGES):
        after = scratch.store(stage(spark, before, SF), f"stage-{i}")
        kept.append((before, after))
        before = after
    for before, after in kept[:-1]:
        assert after.columns == docs.columns
        assert after.exceptAll(docs.crossJoin(F.broadcast(spark.range(3)).select()).select(docs.columns)).count() == 0
    ids = [[r[0] for r in b.select("doc_id").collect()] for b, _ in kept] + [
        [r[0] for r in before.select("doc_id").collect()]
    ]
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    good = {r[0] for r in quality.quality_scores(docs, labels).filter("predicted = 1").collect()}
    assert set(ids[1]) == good and len(ids[1]) < len(ids[0])
    single = near_dedup.near_duplicates(kept[1][0], percent=80).filter("kept")
    assert set(ids[2]) == {r[0] for r in single.select("doc_id").collect()} and len(ids[2]) == len(set(ids[2]))
    assert set(ids[3]) < set(ids[2])
    assert set(ids[4]) < set(ids[3]) and max(ids[4].count(i) for i in ids[4]) <= 3
    final = kept[-1][1]
    assert final.columns == [*docs.columns, "shard", "slot"]
    assert rows_of(final, "doc_id", "text") == rows_of(kept[-1][0], "doc_id", "text")
    for r in final.groupBy("shard").agg(F.min("slot"), F.max("slot"), F.count_distinct("slot"), F.count("*")).collect():
        assert r[1] == 0 and r[2] + 1 == r[3] == r[4] and 0 <= r[0] < 24
    assert rows_of(corpus_pipeline.run(spark, SF), *final.columns) == rows_of(final, *final.columns)


def test_pipeline_with_odd_rows(spark, documents, tmp_path):
    rows = [(1, None), (2, ""), (None, "no id here"), (3, "a b c d e f g h i j k"), (4, "a b c d e f g h i j k")]
    folder = str(tmp_path)
    documents(*rows).withColumn("shard", F.lit("old")).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([], LABELS).write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    got = corpus_pipeline.run(spark, folder)
    assert set(rows_of(got, "doc_id")) == {(3,), (None,)} and got.columns.count("shard") == 1
    empty = str(tmp_path / "empty")
    documents().write.parquet(f"{empty}/documents.parquet")
    spark.createDataFrame([], LABELS).write.parquet(f"{empty}/labels.parquet")
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{empty}/benchmark.parquet")
    assert corpus_pipeline.run(spark, empty).count() == 0


def test_stages_keep_and_drop_single_rows(spark, documents, tmp_path):
    """NULL and repeated identifiers, and rows equal in all columns, of which some are rejected."""
    def text(n):
        return " ".join(f"{chr(97 + n)}{i}" for i in range(60))

    folder = str(tmp_path)
    spark.createDataFrame([(1, text(20))], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    rows = [(None, text(0)), (None, text(1)), (None, text(20)), (7, text(2)), (7, text(20)), (8, text(21)), (8, text(21))]
    got = corpus_pipeline.decontamination_stage(spark, documents(*rows), folder)
    clean = [r for r in rows if r[1] != text(20)]
    assert rows_of(got, "doc_id", "text") == sorted(clean, key=repr)
    rows = [
        (None, text(0)), (None, text(0)), (None, text(1)), (None, text(2)), (5, text(2)), (6, text(3)), (6, text(4)),
        (4, text(4)), (9, text(5)), (9, text(5)), (9, text(5)), (9, text(6)), (None, None), (None, ""), (3, None), (3, None),
    ]
    docs = Scratch(spark, "test").store(documents(*rows).repartition(5), "docs")
    got = corpus_pipeline.near_dedup_stage(spark, docs, folder)
    want = [
        (None, text(0)), (None, text(1)), (5, text(2)), (6, text(3)), (4, text(4)), (9, text(5)), (9, text(6)),
        (None, None), (None, ""), (3, None), (3, None),
    ]
    assert got.columns == docs.columns and rows_of(got, "doc_id", "text") == sorted(want, key=repr)
    # A small source of weight 1 of 3: the sources' limits let each document of the small source in three times.
    rows = [(None, text(i), "a") for i in range(4)] + [(i, text(10), "b") for i in range(60)] + [(None, None, "a")]
    taken = corpus_pipeline.mixing_stage(spark, documents(*rows), folder).filter("source = 'a'")
    assert rows_of(taken, "doc_id", "text") == sorted([r[:2] for r in rows[:4]] * 3, key=repr)


# Names of columns that the pipeline and its operators use inside.
CLASHES = ["key", "_row", "_copies", "_copy", "_taken", "row", "id", "copies", "size", "kept", "shingles", "slot"]


@pytest.mark.parametrize("number", range(5))
def test_stages_keep_columns_of_any_name(spark, documents, number):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(60)
    extra = [F.concat_ws(":", F.lit(name), "doc_id").alias(name) for name in CLASHES]
    wide = Scratch(spark, "test").store(docs.select("*", *extra), "wide")
    _, stage = corpus_pipeline.STAGES[number]
    got = stage(spark, wide, SF)
    added = ["shard", "slot"] if number == 4 else []
    assert got.columns == [c for c in wide.columns if c not in added] + added
    kept = [c for c in CLASHES if c not in added]
    odd = [~F.col(c).eqNullSafe(F.concat_ws(":", F.lit(c), "doc_id")) for c in kept]
    assert got.count() > 0 and got.filter(reduce(lambda a, b: a | b, odd)).isEmpty()


def test_stages_remove_what_the_one_before_left(spark, documents):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    store, folder = Scratch(spark, "test"), shared_folder(spark)

    def left(name):
        return [f for f in os.listdir(folder.removeprefix("file://")) if f.startswith(name)]

    before = {name: left(name) for name in ("near_dedup", "decontamination", "mixing")}
    single = corpus_pipeline.STAGES[1][1](spark, docs, SF)
    assert len(left("near_dedup")) > len(before["near_dedup"])
    # A plan that still reads them keeps them there.
    lazy = corpus_pipeline.STAGES[2][1](spark, single, SF)
    assert lazy.count() > 0 and len(left("near_dedup")) > len(before["near_dedup"])
    single = store.store(corpus_pipeline.STAGES[1][1](spark, docs, SF), "single")
    there = set(left("near_dedup"))
    corpus_pipeline.STAGES[2][1](spark, single, SF)
    assert len(there - set(left("near_dedup"))) == 2


def test_copies_of_items_without_an_identifier_are_dropped(spark, documents, tmp_path):
    folder = str(tmp_path)
    items = [(None, "one two three four"), (3, "five six seven"), (None, None)]
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    rows = [(1, "a one two three four b"), (2, "five six seven"), (4, "two three four"), (5, None)]
    got = corpus_pipeline.decontamination_stage(spark, documents(*rows), folder)
    assert rows_of(got, "doc_id") == [(4,), (5,)]


def test_arrow_groups_cross_batches():
    from tiffin.llm.texts import whole_groups

    keys = [1, 1, 2, 2, 2, 3, 4, 4, 4, 4]
    batches = [pa.RecordBatch.from_pydict({"k": keys[i : i + 3], "v": list(range(i, min(i + 3, 10)))}) for i in range(0, 10, 3)]
    groups = []
    for table, starts in whole_groups(iter(batches), ["k"]):
        for start, end in zip(starts, [*starts[1:], table.num_rows], strict=True):
            part = table.slice(start, end - start).to_pydict()
            assert len(set(part["k"])) == 1
            groups.append(part["v"])
    assert groups == [[0, 1], [2, 3, 4], [5], [6, 7, 8, 9]]
