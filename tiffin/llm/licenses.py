"""License scan: TF-IDF cosine of text lines to license templates, and inheritance along folders.

Each line of a file is a sparse vector of its words, weighted by word count times IDF over all lines of
the table, and is compared with the vectors of the templates. A file carries the license of its best
line or block at or above a bound. A file without one inherits from the license file in its nearest folder
upwards: each file is joined with the licenses of its ancestor folders by path, and the deepest wins.

Words outside all templates weigh as if no line had them, so only template words are counted. A line
can reach ``least`` only if it has one of the heaviest words of a template, those without which the rest
of the template falls short (by the Cauchy-Schwarz inequality); the other lines are passed over without loss.

Licence texts and headers of more than a line (``license_texts``) are compared with blocks: as many words of a file
as the template has, wherever lines break. A block is laid where three words of the template stand in a row,
the first of them a word of licences, at the place that these have in the template, wherever that is; in long
templates places are rounded to 1/64 of their length. A text in which no such three words are left has no block. So the blocks of one template have at most 128 times the words of the file.
Blocks are scored by the same cosine, and need ``BLOCK_LEAST``, as long texts share common words.

All work is DataFrame functions, joins and aggregates. What comes to the driver are the line counts of
template words. Folders and licenses meet in an equi-join on the folder.

Defined cases: a NULL text has no lines; a NULL path has no folder and inherits nothing; ties go to the
smallest license name; several license files in a folder: the best score, then the smallest
license and path; identifiers may be NULL or repeated; an empty table gives an empty result; other columns are not
read.
"""

from __future__ import annotations

import json
import math
import re
from collections import Counter
from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tiffin.llm.license_texts import block_templates
from tiffin.llm.literals import local_table
from tiffin.llm.scratch import Scratch
from tiffin.llm.texts import LOWER, UPPER

LEAST = 0.6
BLOCK_LEAST = 0.8
# Words of licences. The pattern finds every text that has one of them.
_LEGAL = (
    "license", "licensed", "licenses", "licence", "sublicense", "copyright", "creative", "redistribute",
    "redistribution", "redistributions", "warranty", "warranties",
)
_LEGAL_TEXT = "(?i)licen[cs]e|copyright|creative|redistribut|warrant"

# Short notices as they stand in file headers, by SPDX identifier.
TEMPLATES = {
    "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "BSD-3-Clause": "Use of this source code is governed by a BSD 3-Clause license.",
    "CC-BY-4.0": "Licensed under CC BY 4.0.",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
    "CC-BY-SA-4.0": "Licensed under CC BY-SA 4.0.",
    "GPL-2.0": "This work is licensed under the GNU General Public License, version 2.",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "LGPL-3.0": "This work is licensed under the GNU Lesser General Public License, version 3.",
    "MIT": "Released under the MIT License.",
    "MPL-2.0": "This file is subject to the terms of the Mozilla Public License, version 2.0.",
}
_WORD = "[a-z0-9]+"


def terms(text: str) -> list[str]:
    return re.findall(_WORD, text.lower())


def line_terms(line: Column) -> Column:
    """Words of a line, A-Z taken as a-z."""
    return F.regexp_extract_all(F.translate(line, UPPER, LOWER), F.lit(f"({_WORD})"), 1)


def _lines(files: DataFrame) -> DataFrame:
    return files.select("file", F.posexplode(F.split(F.coalesce("text", F.lit("")), "\n"))).select(
        "file", F.col("pos").alias("line_no"), F.col("col").alias("line")
    )


def idf(lines: int, with_term: int) -> float:
    return math.log((1 + lines) / (1 + with_term)) + 1


def heaviest(vector: Mapping[str, float], least: float) -> set[str]:
    """The fewest terms, by weight, without which the rest of the unit vector is shorter than ``least``."""
    chosen, rest = set(), 1.0
    for term, weight in sorted(vector.items(), key=lambda x: (-x[1], x[0])):
        if rest < least * least * (1 - 1e-9):
            break
        chosen.add(term)
        rest -= weight * weight
    return chosen


def _line_counts(files: DataFrame, vocabulary: Iterable[str]) -> dict[str, int]:
    """How many lines have each term; all lines under the empty text."""
    terms_of = F.array_append(F.array_distinct(line_terms(F.col("line"))), F.lit(""))
    seen = _lines(files).select(F.explode(terms_of).alias("term"))
    found = seen.filter(F.col("term").isin("", *vocabulary)).groupBy("term").count()
    return {r["term"]: r["count"] for r in found.collect()}


def license_lines(
    files: DataFrame, templates: Mapping[str, str] = TEMPLATES, least: float = LEAST,
    counts: Mapping[str, int] | None = None,
) -> DataFrame:
    """``(file, line_no, license, score)`` for all pairs of a line and a template that reach ``least``.

    ``files`` has the columns ``file`` and ``text``; files of the same name must have the same text.
    """
    spark = files.sparkSession
    lines = _lines(files)
    counted = {name: Counter(terms(text)) for name, text in templates.items()}
    vocabulary = sorted({t for c in counted.values() for t in c})
    if counts is None:
        counts = _line_counts(files, vocabulary)
    n_lines = counts.get("", 0)
    weight = {t: idf(n_lines, counts.get(t, 0)) for t in vocabulary}
    unknown = idf(n_lines, 0)
    unit, keys = [], set()
    for name, words in sorted(counted.items()):
        vector = {t: n * weight[t] for t, n in words.items()}
        norm = math.sqrt(sum(v * v for v in vector.values()))
        vector = {t: v / norm for t, v in vector.items()}
        keys |= heaviest(vector, least)
        unit += [(name, t, v, weight[t]) for t, v in vector.items()]
    template_terms = local_table(spark, ["license", "term", "unit", "idf"], unit)
    wanted = F.array(*[F.lit(t) for t in sorted(keys)])
    words = (
        lines.withColumn("terms", line_terms(F.col("line")))
        .filter(F.arrays_overlap("terms", wanted))
        .dropDuplicates(["file", "line_no"])
        .select("file", "line_no", F.explode("terms").alias("term"))
        .groupBy("file", "line_no", "term")
        .count()
    )
    weighed = words.join(
        template_terms.select("term", "idf").distinct(), "term", "left"
    ).withColumn("w", F.col("count") * F.coalesce("idf", F.lit(unknown)))
    norms = weighed.groupBy("file", "line_no").agg(F.sqrt(F.sum(F.col("w") * F.col("w"))).alias("norm"))
    dots = (
        weighed.filter("idf is not null")
        .select("file", "line_no", "term", "w")
        .join(template_terms.select("license", "term", "unit"), "term")
        .groupBy("file", "line_no", "license")
        .agg(F.sum(F.col("w") * F.col("unit")).alias("dot"))
    )
    score = F.round(F.col("dot") / F.col("norm"), 6)
    return (
        dots.join(norms, ["file", "line_no"])
        .select("file", "line_no", "license", score.alias("score"))
        .filter(F.col("score") >= least)
    )


def _anchors(templates: Mapping[str, list[str]]) -> dict[str, list[dict]]:
    """Three words in a row that a template has once, the first a word of licences, and where they stand in it."""
    found: dict[str, list[dict]] = {}
    for name, words in sorted(templates.items()):
        threes = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)]
        times = Counter(threes)
        for i, three in enumerate(threes):
            if words[i] not in _LEGAL or times[three] > 1:
                continue
            place = {"t": name, "at": i, "length": len(words), "step": max(1, len(words) // 64)}
            found.setdefault(three, []).append(place)
    return found


def license_blocks(
    files: DataFrame, templates: Mapping[str, str], least: float = BLOCK_LEAST,
    counts: Mapping[str, int] | None = None,
) -> DataFrame:
    """``(file, license, score)`` for all blocks that reach ``least``.

    ``templates`` are named by license, ``#`` and a number.
    """
    spark = files.sparkSession
    listed = {name: terms(text) for name, text in templates.items()}
    vocabulary = sorted({t for words in listed.values() for t in words})
    if counts is None:
        counts = _line_counts(files, vocabulary)
    n_lines = counts.get("", 0)
    weight = {t: idf(n_lines, counts.get(t, 0)) for t in vocabulary}
    unit = []
    for name, words in sorted(listed.items()):
        vector = {t: n * weight[t] for t, n in Counter(words).items()}
        norm = math.sqrt(sum(v * v for v in vector.values()))
        unit += [(name, t, v / norm) for t, v in vector.items()]
    anchors = F.from_json(
        F.lit(json.dumps(_anchors(listed))),
        "map<string, array<struct<t: string, at: int, length: int, step: int>>>",
    )
    words, n = F.col("words"), F.size("words")
    block = "array<struct<t: string, start: int, length: int>>"

    def laid(i: Column) -> Column:
        def start(a: Column) -> Column:
            return (F.floor((i - a["at"]) / a["step"] + 0.5) * a["step"]).cast("int")

        three = F.concat_ws(" ", F.slice(words, i + 1, F.lit(3)))
        blocks = F.transform(
            F.try_element_at(anchors, three),
            lambda a: F.struct(a["t"].alias("t"), start(a).alias("start"), a["length"].alias("length")),
        )
        return F.coalesce(blocks.cast(block), F.array().cast(block))

    places = F.filter(F.sequence(F.lit(0), n - 1), lambda i: F.get(words, i).isin(*_LEGAL))
    blocks = (
        files.filter(F.col("text").rlike(_LEGAL_TEXT))
        .select("file", line_terms(F.col("text")).alias("words"))
        .filter(n > 0)
        .select("file", "words", F.explode(F.array_distinct(F.flatten(F.transform(places, laid)))).alias("b"))
    )
    first = F.greatest(F.col("b.start"), F.lit(0))
    last = F.least(F.col("b.start") + F.col("b.length"), n)
    found = (
        blocks.filter(last > first)
        .select(
            "file", F.col("b.t").alias("t"), F.col("b.start").alias("start"),
            F.explode(F.slice(words, first + 1, last - first)).alias("term"),
        )
        .groupBy("file", "t", "start", "term")
        .count()
    )
    weighed = found.join(
        local_table(spark, ["term", "idf"], list(weight.items())), "term", "left"
    ).withColumn("w", F.col("count") * F.coalesce("idf", F.lit(idf(n_lines, 0))))
    score = F.sum(F.col("w") * F.coalesce("unit", F.lit(0.0))) / F.sqrt(F.sum(F.col("w") * F.col("w")))
    return (
        weighed.join(local_table(spark, ["t", "term", "unit"], unit), ["t", "term"], "left")
        .groupBy("file", "t", "start")
        .agg(F.round(score, 6).alias("score"))
        .filter(F.col("score") >= least)
        .select("file", F.substring_index("t", "#", 1).alias("license"), "score")
    )


def folder_of(path: Column) -> Column:
    """The path up to its last slash; empty for a file at the top."""
    return F.regexp_replace(path, "/?[^/]*$", "")


def ancestors(folder: Column) -> Column:
    """``folder`` and the folders above it, the top (empty) one included, each as its path."""
    parts = F.when(folder != "", F.split(folder, "/")).otherwise(F.array().cast("array<string>"))
    return F.transform(
        F.sequence(F.lit(0), F.size(parts)), lambda n: F.array_join(F.slice(parts, 1, n), "/")
    )


def scan_licenses(
    files: DataFrame, key: str = "doc_id", path: str = "path", text: str = "text",
    license_name: str = r"(?i)^(LICEN[CS]E|COPYING)([._-].*)?$",
    templates: Mapping[str, str] = TEMPLATES, least: float = LEAST, block_least: float = BLOCK_LEAST,
) -> DataFrame:
    """``(doc_id, path, license, score, origin, license_path)``, one row per row of ``files``.

    ``origin`` is ``own``, ``inherited`` or NULL (no license); ``license_path`` is the file the license
    was found in. Files whose name matches ``license_name`` hand their license down.
    """
    scratch = Scratch(files.sparkSession, "licenses")
    # Names a row by its content, so that every pass over the rows gives it the same name.
    name = [F.coalesce(F.col(key).cast("string"), F.lit("")), F.xxhash64(path, text).cast("string")]
    rows = files.select(
        F.concat_ws("|", *name).alias("file"),
        F.col(key).alias("doc_id"),
        F.col(path).alias("path"),
        F.col(text).alias("text"),
    )
    texts, longer = rows.select("file", "text"), block_templates()
    counts = _line_counts(texts, sorted({t for x in (*templates.values(), *longer.values()) for t in terms(x)}))
    lines = license_lines(texts, templates, least, counts).select("file", "license", "score")
    found = lines.unionByName(license_blocks(texts, longer, block_least, counts))
    smallest_first = F.struct((-F.col("score")).alias("s"), F.col("license"))
    own = scratch.store(
        found.groupBy("file")
        .agg(F.min(smallest_first).alias("best"))
        .select(F.col("file"), F.col("best.license").alias("license"), (-F.col("best.s")).alias("score")),
        "own",
    )
    light = rows.select("file", "doc_id", "path", folder_of(F.col("path")).alias("folder"))
    named = F.regexp_extract("path", "([^/]*)$", 1).rlike(license_name)
    by_folder = (
        light.filter(named)
        .join(own, "file")
        .groupBy(F.col("folder").alias("above"))
        .agg(F.min(F.struct((-F.col("score")).alias("s"), F.col("license"), F.col("path"))).alias("l"))
    )
    by_folder = scratch.store(by_folder, "by_folder")
    folders = light.select("folder").filter("folder is not null").distinct()
    nearest = scratch.store(
        folders.withColumn("above", F.explode(ancestors(F.col("folder"))))
        .join(by_folder, "above")
        .groupBy("folder")
        .agg(F.max(F.struct(F.length("above").alias("depth"), F.col("l"))).alias("n"))
        .select("folder", F.col("n.l").alias("l")),
        "nearest",
    )
    has_own = F.col("license").isNotNull()
    return (
        light.join(own, "file", "left")
        .join(nearest, "folder", "left")
        .select(
            "doc_id",
            "path",
            F.coalesce("license", "l.license").alias("license"),
            F.coalesce(F.col("score"), -F.col("l.s")).alias("score"),
            F.when(has_own, F.lit("own")).when(F.col("l").isNotNull(), F.lit("inherited")).alias("origin"),
            F.when(has_own, F.col("path")).otherwise(F.col("l.path")).alias("license_path"),
        )
    )
