"""Licence scan: lines and paragraphs of a text against licence templates.

A span (a line, or a paragraph between blank lines) and a template are normalised alike: A-Z lower
case, everything but a-z and 0-9 a blank. Each becomes the set of its word bigrams, and the score is
the Dice coefficient 2 |A n B| / (|A| + |B|). For a threshold t a template of b bigrams can only
match spans of b t / (2 - t) to b (2 - t) / t bigrams; other templates are not tried. Bigrams of
the spans are looked up in the templates' bigrams, so nothing is compared that shares none.

Defined cases: a null text has no span; spans of fewer than two words are not compared; a span that
occurs twice in a text is reported once, at its first place; of equal scores the template that comes
first in the list wins; rows equal in doc_id and text are reported once. An empty table gives no row; texts of any length are cut to spans whole.
Columns of other names are ignored."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from oddrows.llm import texts

THRESHOLD = 80  # per cent

# Public licence notices and short licence texts, by name.
TEMPLATES = [
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", 'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License.'),
    ("MIT", "Released under the MIT License."),
    ("MIT", "This project is licensed under the MIT License."),
    ("MIT", 'Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.'),
    ("BSD-2-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution."),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0-or-later", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    ("GPL-2.0-or-later", "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version."),
    ("LGPL-2.1", "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation; either version 2.1 of the License, or (at your option) any later version."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-SA-4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-NC-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    ("CC0-1.0", "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work."),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
    ("LicenseRef-All-Rights-Reserved", "All rights reserved."),
]


def _plain(text: str) -> list[str]:
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)
    return [w for w in re.sub("[^a-z0-9]+", " ", lowered).split(" ") if w]


def _bigrams(words: Sequence[str]) -> list[tuple[str, str]]:
    return list(dict.fromkeys(zip(words, words[1:])))


def _bounds(size: int, per_cent: int) -> tuple[int, int]:
    """Smallest and largest bigram count that can reach the threshold against `size` bigrams."""
    low, high = size * per_cent, size * (200 - per_cent)
    return -(-low // (200 - per_cent)), high // per_cent


def _words(span: Column) -> Column:
    lower = F.translate(span, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return F.filter(F.split(F.regexp_replace(lower, "[^a-z0-9]+", " "), " "), lambda w: w != "")


def license_scan(docs: DataFrame, doc_id: str = "doc_id", text: str = "text",
                 templates: Sequence[tuple[str, str]] = TEMPLATES, threshold: int = THRESHOLD) -> DataFrame:
    """doc_id, span (text), license, template (its number), n_bigrams, n_common, dice: one row per
    distinct span with the best template of at least `threshold` per cent."""
    spark = docs.sparkSession
    grams = [(k, name, _bigrams(_plain(body))) for k, (name, body) in enumerate(templates)]
    known = spark.createDataFrame(
        [(k, name, len(g), *_bounds(len(g), threshold), a, b) for k, name, g in grams for a, b in g],
        "template int, license string, size int, low int, high int, a string, b string",
    ).select("template", "license", "size", "low", "high", F.xxhash64("a", "b").alias("_gram"))
    most = max((_bounds(len(g), threshold)[1] for _, _, g in grams if g), default=0)
    least = min((_bounds(len(g), threshold)[0] for _, _, g in grams if g), default=1)

    body = texts.text_or_empty(text)
    spans = F.array_distinct(F.concat(texts.lines_of(body), F.split(body, f"\\n{texts.SPACE}*\\n")))
    rows = docs.select(F.col(doc_id).alias("doc_id"), texts.row_key(text).alias("_row"),
                       F.posexplode_outer(spans).alias("_at", "span"))
    pairs = texts.bound(_words(F.col("span")), lambda w: F.when(
        F.size(w) > F.greatest(F.lit(1), F.lit(least)), F.array_distinct(F.transform(
            F.sequence(F.lit(1), F.size(w) - 1), lambda i: F.xxhash64(F.get(w, i - 1), F.get(w, i))))))
    sized = rows.withColumn("_grams", pairs)
    sized = sized.withColumn("n_bigrams", F.coalesce(F.size("_grams"), F.lit(0)))
    # repeated words can make the set smaller than the word count, so only the set's size is bounded
    each = sized.select("doc_id", "_row", "_at", "n_bigrams", F.explode_outer(
        F.when(F.col("n_bigrams").between(least, most), F.col("_grams"))).alias("_gram"),
        F.when(F.col("n_bigrams").between(least, most), F.col("span")).alias("span"))
    shared = each.join(F.broadcast(known), "_gram").filter(F.col("n_bigrams").between(F.col("low"), F.col("high")))
    # the key is the place and not the span, so repeated rows are counted apart by their row number
    score = shared.groupBy("doc_id", "_row", "_at", "template", "license", "size", "n_bigrams").agg(
        F.count_distinct("_gram").alias("n_common"), F.first("span").alias("span"))
    passed = score.filter(200 * F.col("n_common") >= threshold * (F.col("n_bigrams") + F.col("size")))
    dice = 2 * F.col("n_common") / (F.col("n_bigrams") + F.col("size"))
    best = F.max_by(F.struct("span", "license", "template", "n_bigrams", "n_common", dice.alias("dice")),
                    F.struct(dice, -F.col("template")))
    return passed.groupBy("doc_id", "_row", "_at").agg(best.alias("b")).select("doc_id", "b.*")


def op1(docs: DataFrame) -> DataFrame:
    found = license_scan(docs)
    return found.select("doc_id", "span", "license", F.col("template").cast("bigint").alias("template"),
                        F.col("n_bigrams").cast("bigint").alias("n_bigrams"), "n_common",
                        F.round("dice", 6).alias("dice"))


def _template_rows() -> str:
    quoted = lambda s: "'" + s.replace("'", "''") + "'"
    return ", ".join(f"({k}, {quoted(n)}, {quoted(b)})" for k, (n, b) in enumerate(TEMPLATES))


OP1_SQL = f"""
WITH templates(template, license, body) AS (VALUES {_template_rows()}),
plain_t AS (SELECT template, license, list_filter(string_split(regexp_replace(
  lower(body), '[^a-z0-9]+', ' ', 'g'), ' '), lambda w: w <> '') AS w FROM templates),
gram_t AS (
  SELECT DISTINCT template, license, w[i] || ' ' || w[i + 1] AS g
  FROM (SELECT *, unnest(range(1, len(w))) AS i FROM plain_t)),
size_t AS (SELECT template, count(*) AS b FROM gram_t GROUP BY template),
spans AS (
  SELECT DISTINCT doc_id, unnest(list_concat(string_split(coalesce(text, ''), chr(10)),
    string_split_regex(coalesce(text, ''), '\\n[\\x20\\x09-\\x0D]*\\n'))) AS span FROM documents),
plain AS (
  SELECT doc_id, span, list_filter(string_split(regexp_replace(translate(span,
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^a-z0-9]+', ' ', 'g'), ' '), lambda w: w <> '') AS w
  FROM spans),
gram AS (
  SELECT DISTINCT doc_id, span, w[i] || ' ' || w[i + 1] AS g
  FROM (SELECT *, unnest(range(1, len(w))) AS i FROM plain)),
size_s AS (SELECT doc_id, span, count(*) AS a FROM gram GROUP BY ALL),
common AS (
  SELECT doc_id, span, template, license, count(*) AS c FROM gram JOIN gram_t USING (g) GROUP BY ALL),
scored AS (
  SELECT *, 2.0::DOUBLE * c / (a + b) AS dice FROM common JOIN size_s USING (doc_id, span) JOIN size_t USING (template)
  WHERE 200 * c >= {THRESHOLD} * (a + b))
SELECT doc_id, span, license, template::BIGINT AS template, a::BIGINT AS n_bigrams, c::BIGINT AS n_common,
  round(dice, 6) AS dice
FROM scored QUALIFY row_number() OVER (PARTITION BY doc_id, span ORDER BY dice DESC, template) = 1
"""
