"""License scans: MinHash over overlapping windows finds templates, exact containment verifies them.

A text is the list of its words (runs of letters and digits, in lower case) and their 5-word shingles.
Windows of w = 4, 8, 16, ... shingles begin every w / 4 shingles; a template of t shingles is looked for
among the windows with the smallest w >= 4t / 3, so one of them holds all of it.  Such a window and a
template of which 0.8 is there have a Jaccard similarity of 0.25 at least.  Each of ``BANDS`` bands is
one MinHash value: a template is missed with a probability of at most 0.75**40 = 1e-5.

What is found is verified: containment is the share of the template's distinct shingles that the text
has, and ``THRESHOLD`` of them must be there.

Only DataFrame functions are used.  Texts without any of a few words, of which every shingle of every
template has one, cannot hold a template and are not cut into windows.
"""

from __future__ import annotations

import math
import re
from collections import Counter

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.scratch import Scratch

K = 5
BANDS = 40
THRESHOLD = 0.8
SHINGLES_PER_TASK = 40_000
# Words too common to tell a license from other text.
COMMON = {"this", "that", "with", "from", "have", "will", "under", "which", "such", "into", "without", "other", "only", "when"}
SPLIT = r"[^\p{L}\p{N}]+"

# The wording of public license notices.
TEMPLATES: list[tuple[int, str, str]] = [
    (1, "GPL-notice", "This work is licensed under the GNU General Public License, version 3."),
    (2, "CC-BY-NC-notice", "Licensed under CC BY-NC 4.0."),
    (3, "MIT-notice", "Released under the MIT License."),
    (4, "Apache-2.0-notice", "Licensed under the Apache License, Version 2.0."),
    (
        5,
        "MIT",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        "documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation "
        "the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to "
        "permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright "
        "notice and this permission notice shall be included in all copies or substantial portions of the Software.",
    ),
    (
        6,
        "Apache-2.0-header",
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance "
        "with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required "
        "by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" "
        "BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific "
        "language governing permissions and limitations under the License.",
    ),
    (
        7,
        "BSD-2-Clause",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
        "following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of "
        "conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, "
        "this list of conditions and the following disclaimer in the documentation and/or other materials provided with the "
        "distribution.",
    ),
    (
        8,
        "GPL-3.0-or-later-header",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public "
        "License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later "
        "version. This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the "
        "implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more "
        "details.",
    ),
    (
        9,
        "MPL-2.0-header",
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not "
        "distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/.",
    ),
    (
        10,
        "ISC",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
        "granted, provided that the above copyright notice and this permission notice appear in all copies.",
    ),
    (11, "CC-BY-4.0-notice", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    (12, "CC-BY-SA-4.0-notice", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    (
        13,
        "Unlicense",
        "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, "
        "compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, "
        "commercial or non-commercial, and by any means.",
    ),
]


def words_of(text: Column) -> Column:
    return F.filter(F.split(F.lower(text), SPLIT), lambda w: w != "")


def shingles_of(words: Column) -> Column:
    """Hash of each run of 5 words, by place; none for fewer words.

    ``words`` is to be a column of the input: an expression would be evaluated anew for every word.
    """
    places = F.when(F.size(words) >= K, F.sequence(F.lit(0), F.size(words) - K)).otherwise(F.array().cast("array<int>"))
    return F.transform(places, lambda i: F.xxhash64(*[F.get(words, i + j) for j in range(K)]))


def needed_words(templates: list[tuple[int, str, str]]) -> list[str]:
    """Words, few and long, of which every shingle of every template has one."""
    open_: list[set[str]] = []
    for _, _, text in templates:
        words = re.findall(r"[a-z0-9]+", text.lower())
        open_ += [set(words[i : i + K]) for i in range(len(words) - K + 1)]
    chosen: list[str] = []
    while open_:
        count = Counter(w for s in open_ for w in s)
        best = max(count, key=lambda w: (w not in COMMON and len(w) > 3, count[w] * len(w) ** 2, w))
        chosen.append(best)
        open_ = [s for s in open_ if best not in s]
    return sorted(chosen)


def _width(n: Column) -> Column:
    """Window width of a template of n shingles: the power of two that is at least 4n / 3 and at least 4."""
    return F.greatest(F.lit(4), F.pow(2, F.ceil(F.log2(F.ceil(n * 4 / 3))))).cast("int")


def _minima() -> list[Column]:
    return [F.min(F.xxhash64("s", F.lit(j))).alias(f"m{j}") for j in range(BANDS)]


def _bands(rows: DataFrame, *keep: str) -> DataFrame:
    return rows.select(*keep, F.posexplode(F.array(*[f"m{j}" for j in range(BANDS)])).alias("band", "value"))


def template_table(spark: SparkSession, templates: list[tuple[int, str, str]]) -> DataFrame:
    """(license_id, name, t, w, shingles) of each template of 5 words or more."""
    rows = spark.createDataFrame(templates, "license_id int, name string, body string")
    cut = rows.withColumn("words", words_of(F.col("body"))).withColumn("shingles", F.array_distinct(shingles_of(F.col("words"))))
    cut = cut.withColumn("t", F.size("shingles"))
    return cut.filter("t > 0").select("license_id", "name", "t", _width(F.col("t")).alias("w"), "shingles")


def scan(
    docs: DataFrame,
    templates: list[tuple[int, str, str]] = TEMPLATES,
    id_col: str = "doc_id",
    text_col: str = "text",
    threshold: float = THRESHOLD,
) -> DataFrame:
    """One row for each row of ``docs`` and template found: id, license_id, license, matched, shingles,
    containment, first_word (place of the first word of a template's shingle, from 0).

    Null, empty and short texts have no finds; templates of fewer than 5 words are not looked for; rows
    that repeat an id have their own finds; those with a null id have theirs under null.  An empty table
    gives an empty result; other columns are not read.  The templates are a stated list, small enough to
    be part of the plan; they alone are broadcast.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark, "licenses")
    table = scratch.keep(template_table(spark, templates).coalesce(1), "templates")
    widths = [r["w"] for r in table.select("w").distinct().collect()]
    pattern = rf"(?iu)(?<![\p{{L}}\p{{N}}])(?:{'|'.join(needed_words(templates))})(?![\p{{L}}\p{{N}}])"
    texts = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text")).filter(F.col("text").rlike(pattern))
    cut = scratch.keep(
        texts.select(F.monotonically_increasing_id().alias("row"), "id", words_of(F.col("text")).alias("words"))
        .filter(F.size("words") >= K)
        .select("row", "id", shingles_of(F.col("words")).alias("shingles")),
        "shingles",
    )
    # a text's windows are made where its shingles are: the sums below need no second exchange
    n_shingles = cut.agg(F.coalesce(F.sum(F.size("shingles")), F.lit(0)).alias("n")).first()["n"]
    each = cut.repartition(max(1, math.ceil(n_shingles / SHINGLES_PER_TASK)), "row").select("row", F.posexplode("shingles").alias("i", "s"))
    window = F.explode(F.array(*[F.struct(F.lit(w).alias("w"), (F.floor(F.col("i") / (w // 4)) - back).alias("window")) for w in widths for back in range(4)]))
    sketched = each.select("row", "s", window.alias("at")).groupBy("row", "at").agg(*_minima())
    known = table.select("license_id", "w", F.explode("shingles").alias("s")).groupBy("license_id", "w").agg(*_minima())
    windows = _bands(sketched.withColumn("w", F.col("at.w")), "row", "w")
    found = windows.join(F.broadcast(_bands(known, "license_id", "w")), ["w", "band", "value"]).select("row", "license_id").distinct()
    # the distinct (row, template) pairs meet the row's shingles, and the template's by broadcast
    held = F.array_intersect("own", "wanted")
    return (
        found.join(cut.withColumnRenamed("shingles", "own"), "row")
        .join(F.broadcast(table.withColumnRenamed("shingles", "wanted")), "license_id")
        .withColumn("matched", F.size(held).cast("long"))
        .filter(F.col("matched") >= F.lit(threshold) * F.col("t"))
        .select(
            F.col("id").alias(id_col),
            "license_id",
            F.col("name").alias("license"),
            "matched",
            F.col("t").cast("long").alias("shingles"),
            (F.col("matched") / F.col("t")).alias("containment"),
            (F.array_position(F.transform("own", lambda s: F.array_contains("wanted", s)), True) - 1).alias("first_word"),
        )
    )


def oracle(templates: list[tuple[int, str, str]] = TEMPLATES, threshold: float = THRESHOLD) -> str:
    """The same rows in DuckDB: all documents against all templates, by their shingles."""
    quoted = ", ".join(f"({i}, '{name}', '{body.replace(chr(39), chr(39) * 2)}')" for i, name, body in templates)
    words = lambda text: f"[x for x in regexp_split_to_array(lower({text}), '[^\\p{{L}}\\p{{N}}]+') if x <> '']"
    cut = f"range(1, len(w) - {K - 2})"
    return f"""
    WITH t AS (SELECT license_id, license, {words('body')} AS w FROM (VALUES {quoted}) v(license_id, license, body)),
    ts AS (SELECT DISTINCT license_id, license, unnest([array_to_string(w[j : j + {K - 1}], ' ') for j in {cut}]) AS s FROM t),
    tn AS (SELECT license_id, count(*) AS n FROM ts GROUP BY license_id),
    d AS (SELECT doc_id, {words("coalesce(text, '')")} AS w FROM documents),
    ds AS (SELECT doc_id, unnest({cut}) - 1 AS i, unnest([array_to_string(w[j : j + {K - 1}], ' ') for j in {cut}]) AS s FROM d),
    m AS (SELECT doc_id, license_id, license, count(DISTINCT s) AS matched, min(i) AS first_word
          FROM ds JOIN ts USING (s) GROUP BY ALL)
    SELECT doc_id, license_id, license, CAST(matched AS BIGINT) AS matched, CAST(n AS BIGINT) AS shingles,
           matched / n AS containment, CAST(first_word AS BIGINT) AS first_word
    FROM m JOIN tn USING (license_id) WHERE matched >= {threshold} * n
    """
