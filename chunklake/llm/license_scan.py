"""License statements by MinHash bands over overlapping windows (operator 9).

Texts and templates are sequences of lower-case words; a window is a run of word
shingles about as long as a template, and windows start every few shingles.  A
band is one minimum hash, least(shingle hash xor the band's mask); a window is
checked against a template if they agree in a band.  A window that holds 0.8 of
a template's n shingles and is n + 2 s long, s its step, resembles it by at least
0.8 n / (1.2 n + 2 s); with s at most n / 8, or windows of exactly n shingles at
every place, that is 0.55 or more, so eight bands collide with probability above
1 - 0.45 ** 8 = 0.998.  Candidates are then compared shingle by shingle.

A window can only agree with a template in a band where it holds the very
shingle that is the template's least.  So these few shingles are looked for
first, and minima are taken over the windows around them alone; the collisions
are those that minima over all windows would give.

DataFrame operations only; what is broadcast are the templates.
"""

from __future__ import annotations

import random

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chunklake.llm.common import keyed_rows, table

SHINGLE, BANDS, CONTAINED = 5, 8, 0.8

# Statements and notices of common licenses, by name; each is a template of its own.
TEMPLATES = {
    "agpl-3.0-notice": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as "
        "published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    ),
    "apache-2.0": ("Licensed under the Apache License, Version 2.0.",),
    "apache-2.0-notice": (
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. "
        "You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in "
        "writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, "
        "either express or implied.",
    ),
    "bsd-conditions": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions "
        "are met: Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.",
    ),
    "bsd-3-clause-endorsement": (
        "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from "
        "this software without specific prior written permission.",
    ),
    "bsd-statement": ("Use of this source code is governed by a BSD-style license that can be found in the LICENSE file.",),
    "bsl-1.0": ("Distributed under the Boost Software License, Version 1.0.",),
    "cc-by-4.0": ("This work is licensed under a Creative Commons Attribution 4.0 International License.", "Licensed under CC BY 4.0."),
    "cc-by-nc-4.0": ("Licensed under CC BY-NC 4.0.", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    "cc-by-nc-sa-4.0": ("This work is licensed under a Creative Commons Attribution-NonCommercial-ShareAlike 4.0 International License.",),
    "cc-by-sa-4.0": ("This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.", "Licensed under CC BY-SA 4.0."),
    "cc0-1.0": ("To the extent possible under law, the author has dedicated all copyright and related and neighboring rights to this work to the public domain worldwide.",),
    "gpl-2.0-notice": (
        "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published "
        "by the Free Software Foundation; either version 2 of the License, or (at your option) any later version.",
    ),
    "gpl-3.0": ("This work is licensed under the GNU General Public License, version 3.",),
    "gpl-3.0-notice": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published "
        "by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    ),
    "isc": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that "
        "the above copyright notice and this permission notice appear in all copies.",
    ),
    "lgpl-2.1-notice": (
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as "
        "published by the Free Software Foundation; either version 2.1 of the License, or (at your option) any later version.",
    ),
    "mit": ("Released under the MIT License.", "This project is licensed under the MIT License.", "Licensed under the MIT License."),
    "mit-notice": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "
        "\"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, "
        "distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to "
        "the following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions "
        "of the Software.",
    ),
    "mpl-2.0": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this "
        "file, You can obtain one at http://mozilla.org/MPL/2.0/.",
    ),
    "unlicense": (
        "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, compile, sell, or "
        "distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means.",
    ),
    "zlib": (
        "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages "
        "arising from the use of this software. Permission is granted to anyone to use this software for any purpose, including commercial applications.",
    ),
}


def _masks(bands: int) -> list[int]:
    source = random.Random(9)
    return [source.getrandbits(63) for _ in range(bands)]


def _words(text):
    return F.filter(F.split(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{N}]+"), lambda w: w != "")


def _shingles(words, k: int = SHINGLE):
    """The hash of each run of ``k`` words."""
    each = F.transform(F.sequence(F.lit(0), F.size(words) - k), lambda i: F.xxhash64(*(F.get(words, i + j) for j in range(k))))
    return F.when(F.size(words) >= k, each).otherwise(F.array().cast("array<bigint>"))


def prepare(spark: SparkSession, templates: dict[str, tuple[str, ...]] = TEMPLATES, bands: int = BANDS) -> list[dict]:
    """Each template's shingles, step, window and band minima, as plain values.  They are
    few and given, not data.  A template of fewer than five words is refused."""
    texts_ = [(n, t) for n, ts in templates.items() for t in ts]
    rows = spark.createDataFrame(texts_, "license string, text string")
    masks, out = _masks(bands), []
    for r in rows.select("license", "text", F.array_distinct(_shingles(_words(F.col("text")))).alias("h")).collect():
        n = len(r.h)
        if not n:
            raise ValueError(f"a template of {r.license} has fewer than {SHINGLE} words: {r.text!r}")
        step = max(1, n // 8)
        least = [min(r.h, key=lambda x, m=m: x ^ m) for m in masks]
        out.append({"license": r.license, "shingles": r.h, "step": step, "window": n if step == 1 else n + 2 * step, "least": least})
    return out


def scan(docs: DataFrame, templates: dict[str, tuple[str, ...]] = TEMPLATES, contained: float = CONTAINED, bands: int = BANDS) -> DataFrame:
    """(doc_id, license, containment, word): for each row of ``docs`` and license found in
    it, the best window's share of a template's shingles and its first word.

    Null and short texts have no license.  Repeated rows are reported each; so are
    rows with no id.  Texts may be as long as memory holds: from each place that may
    lie in a license only the shingles around it go on, at most twice the longest window.
    Of ties the earliest place counts.  An empty table, or no template, gives no row.
    """
    spark = docs.sparkSession
    known = prepare(spark, templates, bands) if templates else []
    result = "doc_id long, license string, containment double, word int"
    if not known:
        return spark.createDataFrame([], result)
    wanted, reach = sorted({x for t in known for x in t["least"]}), max(t["window"] for t in known)
    keyed = keyed_rows(docs.select("doc_id", "text"))
    hashed = keyed.select("_row", "doc_id", _words(F.col("text")).alias("words")).select("_row", "doc_id", _shingles(F.col("words")).alias("h"))
    places = F.when(F.size("h") > 0, F.filter(F.sequence(F.lit(0), F.size("h") - 1), lambda i: F.get("h", i).isin(wanted)))
    # What lies around a place, from word ``from`` on.
    begin = lambda i: F.greatest(i - reach, F.lit(0))
    around = F.transform(places, lambda i: F.struct(i.alias("at"), F.get("h", i).alias("x"), begin(i).alias("from"), F.slice("h", begin(i) + 1, F.lit(2 * reach)).alias("near")))
    hits = hashed.select("_row", "doc_id", F.explode(around).alias("hit")).select("_row", "doc_id", "hit.*")
    fields = "license string, shingles array<bigint>, step int, window int, x bigint, mask bigint"
    table_ = [(t["license"], t["shingles"], t["step"], t["window"], x, m) for t in known for x, m in zip(t["least"], _masks(bands), strict=True)]
    # A row for each template and band.
    near = hits.join(F.broadcast(spark.createDataFrame(table_, fields)), "x")
    first = F.greatest(F.ceil((F.col("at") - F.col("window") + 1) / F.col("step")), F.lit(0)).cast("int")
    near = near.withColumn("start", F.explode(F.sequence(first, F.floor(F.col("at") / F.col("step")).cast("int")))).withColumn("start", F.col("start") * F.col("step"))
    near = near.withColumn("inside", F.slice("near", F.col("start") - F.col("from") + 1, F.col("window"))).drop("near")
    agrees = F.array_min(F.transform("inside", lambda y: y.bitwiseXOR(F.col("mask")))) == F.col("x").bitwiseXOR(F.col("mask"))
    near = near.where(agrees).withColumn("containment", F.size(F.array_intersect("shingles", "inside")) / F.size("shingles"))
    found = near.where(F.col("containment") >= contained).groupBy("_row", "doc_id", "license")
    found = found.agg(F.max(F.struct("containment", (-F.col("start")).alias("s"))).alias("best"))
    return found.select(F.col("doc_id").cast("long").alias("doc_id"), "license", "best.containment", (-F.col("best.s")).alias("word"))


def op9_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan(table(spark, sf_dir, "documents"))


QUERIES = {"op9_license_scan": op9_license_scan}
ORACLE_SQL: dict[str, str] = {}
