"""License scans: MinHash bands over overlapping text windows, then exact containment.

Texts are cut in overlapping windows of words. For every template length, each run of so
many words in a window is sketched: the smallest hash of its five-word shingles under each
of several hash functions. A sketch that equals the template's under any function makes a
candidate. Runs and templates have the same number of words, so a run that holds at least
75 % of a template's shingles has a Jaccard similarity of at least 0.6 with it, and
misses all of ``b`` functions with a probability of at most 0.4^b. Candidates are verified by
counting shared shingles.

Before that, texts and windows go that hold none of a template's anchors: words without which
fewer than 75 % of its shingles could be there. This loses nothing. A text is cut in words and
these are looked up among all anchors at once, so texts without a license cost a scan. All of it is
DataFrame functions.
"""

from __future__ import annotations

import math
import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyframe.llm.license_texts import TEXTS

SHINGLE = 5
PERCENT = 75
#: The chance that a matching run goes unseen is below this.
MISS = 1e-6
#: Words of a passage of a longer text.
PASSAGE = 32
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

#: Opening or naming sentences of well-known licenses; notices and paragraphs of bodies follow below.
TEMPLATES = {
    "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "Apache-2.0-notice": (
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in '
        "compliance with the License. You may obtain a copy of the License at"
    ),
    "BSD": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided "
        "that the following conditions are met"
    ),
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
    "CC-BY-SA-4.0": "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "MIT": "Released under the MIT License.",
    "MIT-grant": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
        "associated documentation files"
    ),
    "MPL-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
}


def passages(texts: dict[str, str], size: int = PASSAGE) -> dict[str, str]:
    """Texts of more than ``size`` words as passages of so many, so that excerpts are found too.

    The last passage ends with the text and may share words with the one before. One length
    for all of them keeps the runs few.
    """
    made = {}
    for name, text in texts.items():
        words = re.findall("[A-Za-z0-9]+", text)
        if len(words) <= size:
            made[name] = text
            continue
        for part, at in enumerate([*range(0, len(words) - size, size), len(words) - size], 1):
            made[f"{name}-{part}"] = " ".join(words[at : at + size])
    return made


TEMPLATES |= passages(TEXTS)


@dataclass(frozen=True)
class Template:
    name: str
    words: tuple[str, ...]

    @property
    def shingles(self) -> list[str]:
        many = max(1, len(self.words) - SHINGLE + 1)
        return sorted({" ".join(self.words[at : at + SHINGLE]) for at in range(many)})

    @property
    def needed(self) -> int:
        """Shingles that a match holds at least."""
        return -(-PERCENT * len(self.shingles) // 100)

    def anchors(self) -> list[str]:
        """Words of which every match holds at least one.

        They are chosen, the longest first, until the shingles without any of them are
        fewer than a match needs.
        """
        left, chosen = self.shingles, []
        for word in sorted(set(self.words), key=lambda word: (-len(word), word)):
            if len(left) < self.needed:
                break
            rest = [shingle for shingle in left if word not in shingle.split()]
            if len(rest) < len(left):
                chosen.append(word)
                left = rest
        return chosen


def templates_of(texts: dict[str, str]) -> list[Template]:
    """Templates from texts; those without a word are left out."""
    made = [Template(name, tuple(re.findall("[a-z0-9]+", text.lower()))) for name, text in sorted(texts.items())]
    return [template for template in made if template.words]


def bands_for(miss: float = MISS, percent: int = PERCENT) -> int:
    """Hash functions with which a matching run is missed with at most this probability."""
    jaccard = percent / (200 - percent)
    return math.ceil(math.log(miss) / math.log(1 - jaccard))


def words_of_text(text: Column) -> Column:
    """Words of a text: runs of ASCII letters and digits, A-Z as a-z."""
    return F.regexp_extract_all(F.translate(text, UPPER, LOWER), F.lit("[a-z0-9]+"), F.lit(0))


def shingles_of(words: Column) -> Column:
    """The five-word shingles of an array of words, in order; one for fewer words."""
    return F.transform(
        F.sequence(F.lit(0), F.greatest(F.size(words) - SHINGLE, F.lit(0))),
        lambda at: F.array_join(F.slice(words, at + 1, F.lit(SHINGLE)), " "),
    )


def sketch(shingles: Column, bands: int) -> Column:
    """For each shingle its hashes under all functions."""
    return F.transform(shingles, lambda s: F.transform(F.sequence(F.lit(0), F.lit(bands - 1)), lambda b: F.xxhash64(s, b)))


def template_bands(spark: SparkSession, templates: list[Template], bands: int) -> DataFrame:
    """One row per template and function: ``size, band, least, license, t_shingles, needed``."""
    rows = spark.createDataFrame(
        [(t.name, len(t.words), t.shingles, t.needed) for t in templates],
        "license string, size int, t_shingles array<string>, needed int",
    )
    return rows.withColumn("hashes", sketch(F.col("t_shingles"), bands)).select(
        "*", F.explode(F.sequence(F.lit(0), F.lit(bands - 1))).alias("band")
    ).withColumn("least", F.array_min(F.transform("hashes", lambda h: F.element_at(h, F.col("band") + 1)))).drop("hashes")


def find_licenses(
    documents: DataFrame, texts: dict[str, str] = TEMPLATES, miss: float = MISS
) -> DataFrame:
    """Every matching run: ``doc_id, license, start`` (in words, from 0) and ``shared`` of ``total`` shingles.

    ``documents`` has ``doc_id`` and ``text``; other columns are left out. Null, empty and
    blank texts match nothing. A text shorter than a template is one run. Rows of one id are
    taken together. An empty table or no templates give an empty result. What is broadcast
    is a row per template and hash function.
    """
    spark = documents.sparkSession
    templates = templates_of(texts)
    schema = f"doc_id {dict(documents.dtypes)['doc_id']}, license string, start int, shared int, total int"
    if not templates:
        return spark.createDataFrame([], schema)
    bands = bands_for(miss)
    stride = max(32, max(len(t.words) for t in templates))
    anchors = sorted({word for t in templates for word in t.anchors()})
    by_length = {
        size: F.array(*map(F.lit, sorted({word for t in templates if len(t.words) == size for word in t.anchors()})))
        for size in sorted({len(t.words) for t in templates})
    }
    cut = (
        documents.select("doc_id", words_of_text(F.col("text")).alias("words"))
        .filter(F.arrays_overlap("words", F.array(*map(F.lit, anchors))))
        .select("doc_id", F.size("words").alias("n"), "words", F.explode(F.sequence(F.lit(0), F.size("words") - 1, F.lit(stride))).alias("at"))
        .select("doc_id", "n", "at", F.slice("words", F.col("at") + 1, F.lit(2 * stride)).alias("window"))
        .withColumn("sizes", F.array_compact(F.array(*[F.when(F.arrays_overlap("window", words), F.lit(size)) for size, words in by_length.items()])))
        .filter(F.size("sizes") > 0)
        .select("doc_id", "n", "at", "sizes", shingles_of(F.col("window")).alias("shingles"))
        .withColumn("hashes", sketch(F.col("shingles"), bands))
    )
    # Runs that begin in the first half; the others begin in the next window's first half.
    runs = (
        cut.select("*", F.explode("sizes").alias("size"))
        .select("*", F.explode(F.sequence(F.lit(0), F.lit(stride - 1))).alias("inside"))
        .filter(F.col("at") + F.col("inside") <= F.greatest(F.col("n") - F.col("size"), F.lit(0)))
        .withColumn("many", F.greatest(F.col("size") - SHINGLE + 1, F.lit(1)))
        .select(
            "doc_id", "size", (F.col("at") + F.col("inside")).alias("start"),
            F.slice("shingles", F.col("inside") + 1, F.col("many")).alias("shingles"),
            F.slice("hashes", F.col("inside") + 1, F.col("many")).alias("hashes"),
        )
        .select(
            "doc_id", "size", "start", "shingles",
            F.posexplode(
                F.transform(
                    F.sequence(F.lit(0), F.lit(bands - 1)),
                    lambda b: F.array_min(F.transform("hashes", lambda h: F.element_at(h, b + 1))),
                )
            ).alias("band", "least"),
        )
    )
    known = F.broadcast(template_bands(spark, templates, bands))
    shared = F.size(F.array_intersect("shingles", "t_shingles"))
    found = runs.join(known, ["size", "band", "least"]).withColumn("shared", shared).filter("shared >= needed")
    # A run is a candidate under several hash functions; rows of one id are taken together.
    return found.groupBy("doc_id", "license", "start").agg(
        F.max("shared").alias("shared"), F.max(F.size("t_shingles")).alias("total")
    )


def scan_licenses(documents: DataFrame, texts: dict[str, str] = TEMPLATES, miss: float = MISS) -> DataFrame:
    """Per document id and license found: ``windows``, ``first_word`` and ``containment`` of the best run.

    Rows with the same id are taken together; a run of the same words at the same place in
    two of them counts once.
    """
    return find_licenses(documents, texts, miss).groupBy("doc_id", "license").agg(
        F.count(F.lit(1)).alias("windows"),
        F.min("start").cast("long").alias("first_word"),
        F.round(F.max(F.col("shared") / F.col("total")), 6).alias("containment"),
    )
