"""License scans with DataFrame functions only.

A text's words give 5-word shingles. Overlapping windows of twice a template's length, a template's length apart, hold any
stretch of that length whole. MinHash bands of a window (one row each, BANDS of them) retrieve templates; a window that
contains 0.8 of a template has a Jaccard similarity of at least 0.8 / 2.2 to it, so all bands miss with a probability of
(1 - 0.8 / 2.2) ** 32, about 5e-7. The share of the template's shingles in the window is then computed exactly.

A band can collide only where the window holds the template's minimal shingle for it, so windows without any template's
minimal shingles are not hashed; this loses no collision.

Cases: null and empty texts match nothing; a text or template of fewer than five words is one shingle of all its words;
ids may repeat or be null: rows that differ in id or text are documents of their own, rows that agree in both give one row
per license; ties in containment go to the earliest
window; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

SHINGLE = 5
BANDS = 32
CONTAINMENT = 0.8

# The wording of common public license notices.
TEMPLATES = {
    "apache-2.0-header": "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License.",
    "apache-2.0-line": "Licensed under the Apache License, Version 2.0.",
    "bsd-conditions": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.",
    "cc-by-4.0-line": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "cc-by-nc-4.0-line": "Licensed under CC BY-NC 4.0.",
    "cc-by-sa-4.0-line": "Licensed under CC BY-SA 4.0.",
    "gpl-3-header": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    "gpl-3-line": "This work is licensed under the GNU General Public License, version 3.",
    "isc": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.",
    "mit-line": "Released under the MIT License.",
    "mit-permission": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:",
    "mpl-2.0-header": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/.",
}


def word_array(text: Column) -> Column:
    return F.array_remove(F.split(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{N}]+"), "")


def bound(value: Column, use) -> Column:
    """``use(value)`` with the value computed once, however often ``use`` refers to it and wherever the optimiser moves it."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def shingle_hashes(words: Column, width: int = SHINGLE) -> Column:
    """64-bit hashes of the word shingles, in order; a shorter text is one shingle."""

    def hashes(w: Column) -> Column:
        many = F.transform(F.sequence(F.lit(0), F.greatest(F.size(w) - width, F.lit(0))), lambda i: F.xxhash64(*[F.get(w, i + k) for k in range(width)]))
        none = F.array().cast("array<bigint>")
        return F.when(F.size(w) >= width, many).when(F.size(w) > 0, F.array(F.xxhash64(F.array_join(w, " ")))).otherwise(none)

    return bound(words, hashes)


def min_hashes(shingles: Column, bands: int = BANDS) -> Column:
    return F.transform(F.sequence(F.lit(0), F.lit(bands - 1)), lambda k: F.array_min(F.transform(shingles, lambda x: F.xxhash64(x, k))))


def template_table(spark: SparkSession, templates: dict[str, str]) -> DataFrame:
    """(license, set, t, bands, minimal): shingle set, its size, band values, and the shingles that attain them."""
    t = spark.createDataFrame(sorted(templates.items()), "license string, text string")
    t = t.select("license", F.array_distinct(shingle_hashes(word_array(F.col("text")))).alias("set"))
    t = t.withColumn("t", F.size("set")).withColumn("bands", min_hashes(F.col("set")))
    attains = F.flatten(F.transform(F.sequence(F.lit(0), F.lit(BANDS - 1)), lambda k: F.filter("set", lambda x: F.xxhash64(x, k) == F.get("bands", k))))
    return t.withColumn("minimal", F.array_distinct(attains))


def scan(docs: DataFrame, templates: dict[str, str] = TEMPLATES, containment: float = CONTAINMENT, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Rows (doc_id, license, containment, start_word), one per document and license found; the best window counts."""
    spark = docs.sparkSession
    known = template_table(spark, templates)
    # the templates are a fixed list, some hundred numbers in all
    rows = known.select("license", "set", "t", "bands", "minimal").collect()
    known = F.broadcast(spark.createDataFrame([(r.t, r.license, r.set, k, b) for r in rows for k, b in enumerate(r.bands)], "t int, license string, set array<bigint>, band int, value bigint"))
    by_length: dict[int, set] = {}
    for r in rows:
        by_length.setdefault(r.t, set()).update(r.minimal)
    telling = F.broadcast(spark.createDataFrame([(t, s) for t, ss in sorted(by_length.items()) for s in sorted(ss)], "t int, shingle bigint"))
    every = F.array(*[F.lit(s) for s in sorted(set().union(*by_length.values()))])

    d = docs.select(F.col(id_col).alias("doc_id"), F.xxhash64(text_col).alias("th"), shingle_hashes(word_array(F.col(text_col))).alias("h")).filter(F.arrays_overlap("h", every))
    at = d.select("doc_id", "th", "h", F.posexplode("h").alias("pos", "shingle")).join(telling, "shingle")
    # a position lies in two windows of 2t shingles that start at multiples of t
    near = F.floor(F.col("pos") / F.col("t")).cast("int")
    windows = at.select("doc_id", "th", "h", "t", F.explode(F.array(near - 1, near)).alias("w")).filter("w >= 0")
    windows = windows.select("doc_id", "th", "t", "w", F.slice("h", F.col("w") * F.col("t") + 1, 2 * F.col("t")).alias("in")).dropDuplicates(["doc_id", "th", "t", "w", "in"])
    banded = windows.select("doc_id", "th", "t", "w", "in", F.posexplode(min_hashes(F.col("in"))).alias("band", "value"))
    found = banded.join(known, ["t", "band", "value"]).groupBy("doc_id", "th", "license", "t", "w", "in", "set").agg(F.count("*").alias("bands"))
    share = F.size(F.array_intersect("in", "set")) / F.col("t")
    found = found.select("doc_id", "th", "license", share.alias("containment"), (F.col("w") * F.col("t")).alias("start_word")).filter(F.col("containment") >= containment)
    best = found.groupBy("doc_id", "th", "license").agg(F.max(F.struct("containment", (-F.col("start_word")).alias("s"))).alias("b"))
    return best.select("doc_id", "license", F.col("b.containment").alias("containment"), (-F.col("b.s")).alias("start_word"))
