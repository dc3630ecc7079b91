"""License scans by MinHash over text windows, in DataFrame functions only.

A license template matches a document if at least ``CONTAINED`` of its distinct
3-word shingles (letters and digits, lower-cased) stand in one window of the
document. Windows of a template's class are a quarter of their length apart and
so long that any stretch with the template's number of words lies whole in one.

1. *Anchors* (lossless). Each template has a few words without which too few of its
   shingles would be left to match; a document without any such word is done.
2. *Windows.* Only windows with enough template shingles to match a template
   of their class go on (lossless too: others fail the verification).
3. *MinHash bands* retrieve templates of the window's class. A window that
   matches has at least the Jaccard similarity ``least_similarity``; the number of
   bands follows from it, so that a match is missed with at most ``MISS``.
4. *Verification.* The template's shingles contained in the window are counted.
   Templates of a class compete only for the same stretch: if at least ``SAME`` of
   the matched shingles stand at the same places, the one contained most stays.

Templates are broadcast: a fixed list, or a parameter of at most
``MOST_TEMPLATES``. A null or empty text matches nothing; repeated rows give one
row for each doc_id and license; extra columns are ignored; an empty table
gives an empty table.
"""

from __future__ import annotations

import math
import re
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

K = 3
CONTAINED = 0.8
MISS = 1e-4
SAME = 0.75
MOST_TEMPLATES = 5000
_LENGTHS = (8, 12, 16, 24, 32, 48, 64, 96, 128, 192, 256, 384, 512, 768, 1024, 1536, 2048, 3072, 4096, 8192)

# Public license notices, in their usual wording.
TEMPLATES = {
    "mit-line": "Released under the MIT License.",
    "mit-line-2": "Licensed under the MIT License.",
    "apache-2.0-line": "Licensed under the Apache License, Version 2.0.",
    "gpl-3.0-line": "This work is licensed under the GNU General Public License, version 3.",
    "gpl-2.0-line": "This work is licensed under the GNU General Public License, version 2.",
    "cc-by-nc-4.0-line": "Licensed under CC BY-NC 4.0.",
    "cc-by-4.0-line": "Licensed under CC BY 4.0.",
    "cc-by-sa-4.0-line": "Licensed under CC BY-SA 4.0.",
    "all-rights-reserved": "All rights reserved.",
    "mpl-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/.",
    "apache-2.0": "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License.",
    "mit": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.",
    "isc": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.",
    "bsd-2-clause": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.",
    "gpl-3.0": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    "unlicense": "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means.",
}


def words_of(text: str) -> list[str]:
    return [w for w in re.split("[^a-z0-9]+", re.sub("[A-Z]", lambda m: m[0].lower(), text)) if w]


def _shingles_of(words: list[str]) -> set[tuple[str, ...]]:
    return {tuple(words[i : i + K]) for i in range(len(words) - K + 1)}


def needed(size: int) -> int:
    """Shingles of a template of ``size`` shingles that a match contains."""
    return math.ceil(CONTAINED * size - 1e-9)


def window_length(n_words: int) -> int:
    """The class of a template: the shortest length whose windows, a quarter of
    it apart, hold any stretch of ``n_words`` words whole."""
    return next(w for w in _LENGTHS if w >= n_words + w // 4 - 1)


def least_similarity(length: int, size: int) -> float:
    """Jaccard similarity to its template of a window that just matches."""
    return needed(size) / (length - K + 1 + size - needed(size))


def bands(similarity: float) -> int:
    """Bands of one MinHash value that miss this similarity with at most ``MISS``."""
    return 1 if similarity >= 1 else math.ceil(math.log(MISS) / math.log1p(-similarity))


def anchors(templates: dict[str, str]) -> list[str]:
    """Words one of which every match holds: from each template, words until
    the shingles without any are too few for a match. Long words come first,
    as they are rarer in texts."""
    out: set[str] = set()
    for text in templates.values():
        left = _shingles_of(words_of(text))
        need = needed(len(left))
        chosen: set[str] = set()
        while len(left) >= need:
            best = max({w for s in left for w in s}, key=lambda w: (w in out, len(w) > 3, sum(w in s for s in left) * min(len(w), 8), w))
            chosen.add(best)
            left = {s for s in left if best not in s}
        out |= chosen
    return sorted(out)


def template_table(spark: SparkSession, templates: dict[str, str]) -> DataFrame:
    """license, length (class), shingles (distinct hashes), need."""
    if len(templates) > MOST_TEMPLATES:
        raise ValueError(f"at most {MOST_TEMPLATES} templates are broadcast")
    rows = []
    for name, text in templates.items():
        words = words_of(text)
        if len(words) < K:
            raise ValueError(f"template {name} has fewer than {K} words")
        size = len(_shingles_of(words))
        rows.append((name, " ".join(words), window_length(len(words)), needed(size)))
    made = spark.createDataFrame(rows, "license string, words string, length int, need int")
    made = made.withColumn("words", F.split("words", " "))
    return made.select("license", "length", "need", F.array_distinct(_hashes(F.col("words"))).alias("shingles"))


def _let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with ``value`` made once for the row; the optimizer would
    otherwise copy it into lambdas, where it is made for each element."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _hashes(words: Column) -> Column:
    last = F.size(words) - K
    return F.when(last >= 0, F.transform(F.sequence(F.lit(0), last), lambda i: F.xxhash64(*[F.get(words, i + j) for j in range(K)]))).otherwise(
        F.array().cast("array<bigint>")
    )


def _signature(shingles: Column, n: int) -> Column:
    return F.transform(F.sequence(F.lit(0), F.lit(n - 1)), lambda j: F.array_min(F.transform(shingles, lambda h: F.xxhash64(h, j))))


def license_matches(docs: DataFrame, templates: dict[str, str] | None = None) -> DataFrame:
    """doc_id, license, containment (the best window's) and first_word (where
    the first of the best windows begins, in words)."""
    spark = docs.sparkSession
    templates = templates or TEMPLATES
    table = template_table(spark, templates)
    listed = table.collect()  # the given templates
    vocabulary = sorted({h for r in listed for h in r["shingles"]})
    classes = {
        length: (min(r["need"] for r in group), bands(min(least_similarity(length, len(r["shingles"])) for r in group)))
        for length in sorted({r["length"] for r in listed})
        for group in [[r for r in listed if r["length"] == length]]
    }

    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    pattern = "(?i)(?<![A-Za-z0-9])(?:" + "|".join(anchors(templates)) + ")(?![A-Za-z0-9])"
    some = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text")).where(F.rlike("text", F.lit(pattern)))
    lower = F.translate("text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    words = F.filter(F.split(lower, "[^a-z0-9]+"), lambda w: w != "")
    folded = F.split(F.lit(",".join(map(str, vocabulary))), ",").cast("array<bigint>")

    def windows(s: Column, hits: Column, length: int, need: int) -> Column:
        step, inside = length // 4, length - K + 1
        starts = F.array_distinct(F.flatten(F.transform(hits, lambda i: F.transform(
            F.sequence(F.floor(F.greatest(i - inside + step, F.lit(0)) / step).cast("int"), F.floor(i / step).cast("int")), lambda k: k * step))))
        rich = F.filter(starts, lambda a: F.size(F.filter(hits, lambda i: (i >= a) & (i < a + inside))) >= need)
        return F.transform(rich, lambda a: F.struct(F.lit(length).alias("length"), a.alias("start"), F.slice(s, a + 1, inside).alias("inside")))

    def rich_windows(s: Column) -> Column:
        """Windows with enough template shingles for a match of their class."""
        places = lambda here: F.filter(F.sequence(F.lit(0), F.size(s) - 1), lambda i: F.array_contains(here, F.get(s, i)))
        hits = _let(F.array_intersect(s, folded), lambda here: F.when(F.size(here) > 0, places(here)).otherwise(F.array().cast("array<int>")))
        return _let(hits, lambda h: F.concat(*[windows(s, h, length, need) for length, (need, _) in classes.items()]))

    w = some.select("doc_id", F.explode(_let(words, lambda t: _let(_hashes(t), rich_windows))).alias("w")).select("doc_id", "w.*")
    # The bands of each class, as (length, seat, value) hashes.
    def banded(shingles: Column) -> Column:
        out = F.array().cast("array<bigint>")
        for length, (_, n) in classes.items():
            out = F.when(F.col("length") == length, _signature(shingles, n)).otherwise(out)
        return out

    left = w.select("*", F.posexplode(banded(F.col("inside"))).alias("seat", "value"))
    right = table.select("license", "length", "need", "shingles", F.posexplode(banded(F.col("shingles"))).alias("seat", "value"))
    met = left.join(F.broadcast(right), ["length", "seat", "value"])
    common = F.size(F.array_intersect("inside", "shingles"))
    places = F.filter(F.sequence(F.lit(0), F.size("inside") - 1), lambda i: F.array_contains("shingles", F.get("inside", i)))
    at = F.transform(places, lambda i: i + F.col("start"))
    # A window that meets a template in several bands is one match.
    once = met.where(common >= F.col("need")).dropDuplicates(["doc_id", "license", "length", "start"])
    checked = once.select("doc_id", "license", "length", "start", (common / F.size("shingles")).alias("c"), at.alias("at"))
    # Of templates that differ in a version or name only, one stretch is the one it holds most of.
    # Windows with a place in common are at most three steps apart.
    step = F.floor(F.col("start") * 4 / F.col("length"))
    near = F.collect_list(F.struct("c", "at")).over(Window.partitionBy("doc_id", "length").orderBy(step).rangeBetween(-3, 3))
    better = F.exists("near", lambda o: (o["c"] > F.col("c")) & (F.size(F.array_intersect(o["at"], "at")) >= SAME * F.greatest(F.size("at"), F.size(o["at"]))))
    checked = checked.withColumn("near", near).where(~better)
    best = checked.groupBy("doc_id", "license").agg(F.max(F.struct(F.col("c"), (-F.col("start")).alias("first"))).alias("m"))
    return best.select("doc_id", "license", F.round("m.c", 6).alias("containment"), (-F.col("m.first")).cast("long").alias("first_word"))


def op5_license_scan(docs: DataFrame) -> DataFrame:
    return license_matches(docs)
