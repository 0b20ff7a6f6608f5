"""License texts in documents: MinHash bands over overlapping windows find templates, exact containment confirms them.

Windows have the size class of a template and overlap so that any run of a template's length lies inside one of them.
A run that holds 0.8 of a template's shingles then has a Jaccard similarity of at least 0.3 to it within its window;
with one row in each of 32 bands such a window meets its template with probability over 1 - 0.7 ** 32 = 0.99998.
Windows without any template shingle, which no band could match, are left out first. Built-in functions only; the
documents are read once and only finds are shuffled.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakemart.session import materialize

SHINGLE_WORDS = 5
CONTAINMENT = 0.8
BANDS = 32
CLASS_RATIO = 1.5

# Notices as their licenses word them.
TEMPLATES = {
    "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "MIT": "Released under the MIT License.",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
    "CC-BY-4.0": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "Apache-2.0-notice": "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance "
    "with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by "
    "applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT "
    "WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing "
    "permissions and limitations under the License.",
    "MIT-text": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
    "documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights "
    "to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to "
    "whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission "
    "notice shall be included in all copies or substantial portions of the Software.",
    "ISC-text": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
    "granted, provided that the above copyright notice and this permission notice appear in all copies.",
    "GPL-3.0-notice": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
    "Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later "
    "version. This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied "
    "warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details.",
    "MPL-2.0-notice": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was "
    "not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/.",
}


def _words(text: Column) -> Column:
    """Lower-cased runs of letters and digits."""
    return F.filter(F.split(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{N}]+"), lambda w: w != "")


def _shingles(words: Column, size: Column) -> Column:
    """Hashes of five words at a time, in order; fewer words are one shingle."""
    words_of = [F.when(size > k, F.get(words, k)) for k in range(SHINGLE_WORDS)]
    several = F.transform(F.sequence(F.lit(0), size - SHINGLE_WORDS), lambda i: F.xxhash64(*[F.get(words, i + k) for k in range(SHINGLE_WORDS)]))
    return F.when(size >= SHINGLE_WORDS, several).when(size > 0, F.array(F.xxhash64(*words_of))).otherwise(F.expr("cast(array() as array<bigint>)"))


def _band_keys(shingles: Column, n_bands: int) -> Column:
    """One key per band: the smallest of the shingles' hashes under the band's seed."""
    return F.array(*[F.xxhash64(F.lit(b), F.array_min(F.transform(shingles, _seeded(b)))) for b in range(n_bands)])


def _seeded(band: int):
    return lambda h: F.xxhash64(h, F.lit(band))


def _longs(values: list[int]) -> Column:
    return F.expr("array(" + ", ".join(f"{v}L" if v > -(2**63) else "-9223372036854775807L - 1L" for v in values) + ")")


def prepared_templates(spark: SparkSession, templates: dict[str, str]) -> list[dict]:
    """Name, distinct shingles and their number for each template with a word; the size is that of the templates."""
    frame = spark.createDataFrame(sorted(templates.items()), "license string, text string").withColumn("words", _words(F.col("text")))
    frame = frame.withColumn("size", F.size("words")).withColumn("shingles", F.array_distinct(_shingles(F.col("words"), F.col("size"))))
    return [row.asDict() for row in frame.where("size > 0").select("license", "shingles").orderBy("license").collect()]


def size_classes(sizes: list[int]) -> list[int]:
    """Largest template size of each class; within a class sizes differ by less than ``CLASS_RATIO``."""
    classes: list[int] = []
    for size in sorted(set(sizes), reverse=True):
        if not classes or size * CLASS_RATIO <= classes[-1]:
            classes.append(size)
    return classes


def _windows(largest: int) -> Column:
    """``class, start, window`` for every window of a size class that holds a hit; windows begin at multiples of a stride."""
    stride = max(1, largest // 2)
    length = largest + stride

    def around(hit: Column) -> Column:
        return F.sequence(F.greatest(F.lit(0), F.ceil((hit - length + 1) / stride).cast("int")), F.floor(hit / stride).cast("int"))

    numbers = F.array_distinct(F.flatten(F.transform("hits", around)))
    return F.transform(
        numbers,
        lambda n: F.struct(F.lit(largest).alias("class"), (n * stride).alias("start"), F.slice("shingles", n * stride + 1, F.lit(length)).alias("window")),
    )


def find_licenses(
    docs: DataFrame,
    templates: dict[str, str] | None = None,
    id_col: str = "doc_id",
    text_col: str = "text",
    containment: float = CONTAINMENT,
    bands: int = BANDS,
) -> DataFrame:
    """One row ``id, license, containment, first_word`` per document and license template that it holds.

    ``containment`` is the share of the template's distinct shingles in the best window, ``first_word`` the place of
    the first of them there, from 0; ties go to the earlier window. A template of fewer than five words is one shingle
    and is found only as a whole document. Null and empty texts hold none. Rows that repeat id and text give one
    result, null ids are passed on, other columns are ignored, no templates or an empty table give an empty result.
    """
    spark = docs.sparkSession
    known = prepared_templates(spark, TEMPLATES if templates is None else templates)
    schema = f"`{id_col}` {docs.schema[id_col].dataType.simpleString()}, license string, containment double, first_word long"
    if not known:
        return spark.createDataFrame([], schema)
    text = F.col(text_col)
    # A row number is not deterministic and so keeps the filter from being pushed below the arrays and computing them again.
    row = F.monotonically_increasing_id()
    frame = docs.select(F.col(id_col).alias("id"), F.xxhash64(text).alias("text_key"), _words(text).alias("words"), row.alias("row"))
    frame = frame.select("id", "text_key", "words", F.size("words").alias("size"), row.alias("row"))
    frame = frame.select("id", "text_key", _shingles(F.col("words"), F.col("size")).alias("shingles"), row.alias("row"))
    every = _longs(sorted({h for t in known for h in t["shingles"]}))
    met = F.array_intersect("shingles", every)
    # The few texts with a hit are written once; further lambdas then refer to stored arrays, not to expressions.
    frame = materialize(frame.select("id", "text_key", "shingles", met.alias("met"), row.alias("row")).where(F.size("met") > 0), "license_hits")
    hits = F.filter(F.transform("shingles", lambda h, i: F.when(F.array_contains("met", h), i)), lambda i: i.isNotNull())
    frame = materialize(frame.select("id", "text_key", "shingles", hits.alias("hits")), "license_places")
    classes = size_classes([len(t["shingles"]) for t in known])
    windows = frame.select("id", "text_key", F.explode(F.concat(*[_windows(c) for c in classes])).alias("w")).select("id", "text_key", "w.*")
    rows = []
    for template in known:
        own = min(c for c in classes if c >= len(template["shingles"]))
        rows.append((template["license"], own, template["shingles"]))
    table = spark.createDataFrame(rows, "license string, class int, template array<bigint>")
    table = table.withColumn("key", F.explode(_band_keys(F.col("template"), bands)))
    met = (
        windows.withColumn("keys", _band_keys(F.col("window"), bands)).withColumn("key", F.explode("keys")).drop("keys")
        .join(F.broadcast(table), ["class", "key"])
        .withColumn("containment", F.size(F.array_intersect("template", "window")) / F.size("template"))
        .where(F.col("containment") >= containment)
    )
    first = F.col("start") + F.array_min(F.transform(F.array_intersect("window", "template"), lambda h: F.array_position("window", h))) - 1
    found = met.select("id", "text_key", "license", "containment", (-first).cast("long").alias("minus"))
    best = found.groupBy("id", "text_key", "license").agg(F.max(F.struct("containment", "minus")).alias("best"))
    return best.select(F.col("id").alias(id_col), "license", F.col("best.containment").alias("containment"), (-F.col("best.minus")).alias("first_word"))
