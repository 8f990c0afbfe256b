"""Licence notices and texts: Dice coefficient over word bigrams against templates.

Segments of a text (its lines, its paragraphs and the whole) are normalised to lower-case words and compared
to every template; a segment matches where 2 * common / (segment + template) reaches ``DICE`` over distinct
bigrams. Two exact bounds prune: sizes must lie within a factor of DICE / (2 - DICE), and a matching segment
holds at least that share of the template's bigrams, so it has at least one of any words that touch more
than the rest. Such signal words are derived from the templates, and texts without any are not cut up.

Defined results: null texts are empty and match nothing; each document gives one row; of several matches of
one segment the template with the highest coefficient counts (ties: the first name); repeated rows are
reported each; an empty table gives no rows.
"""

from __future__ import annotations

import re
from fractions import Fraction

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgerloom.llm.common import stored, whole_text

DICE = Fraction(4, 5)

# Wording of public licences (notices, and the grant or disclaimer that opens the full text).
TEMPLATES = {
    "Apache-2.0-notice": "Licensed under the Apache License, Version 2.0.",
    "Apache-2.0-header": (
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in "
        "compliance with the License. You may obtain a copy of the License at "
        "http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, "
        "software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR "
        "CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing "
        "permissions and limitations under the License."
    ),
    "MIT-notice": "Released under the MIT License.",
    "MIT-grant": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
        "associated documentation files (the \"Software\"), to deal in the Software without restriction, "
        "including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, "
        "and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, "
        "subject to the following conditions: The above copyright notice and this permission notice shall be "
        "included in all copies or substantial portions of the Software."
    ),
    "GPL-3.0-notice": "This work is licensed under the GNU General Public License, version 3.",
    "GPL-3.0-header": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU "
        "General Public License as published by the Free Software Foundation, either version 3 of the License, "
        "or (at your option) any later version. This program is distributed in the hope that it will be useful, "
        "but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A "
        "PARTICULAR PURPOSE. See the GNU General Public License for more details."
    ),
    "BSD-3-Clause-grant": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided "
        "that the following conditions are met: Redistributions of source code must retain the above copyright "
        "notice, this list of conditions and the following disclaimer. Redistributions in binary form must "
        "reproduce the above copyright notice, this list of conditions and the following disclaimer in the "
        "documentation and/or other materials provided with the distribution. Neither the name of the copyright "
        "holder nor the names of its contributors may be used to endorse or promote products derived from this "
        "software without specific prior written permission."
    ),
    "ISC-grant": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is "
        "hereby granted, provided that the above copyright notice and this permission notice appear in all copies."
    ),
    "MPL-2.0-header": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the "
        "MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/."
    ),
    "CC-BY-NC-4.0-notice": "Licensed under CC BY-NC 4.0.",
    "CC-BY-4.0-notice": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "CC0-1.0-notice": "To the extent possible under law, the author has waived all copyright and related rights to this work.",
    "Unlicense-grant": "This is free and unencumbered software released into the public domain.",
}


def words_of(text: str) -> list[str]:
    return re.findall(r"[a-z0-9]+", text.lower())


def bigrams_of(text: str) -> set[str]:
    words = words_of(text)
    return {f"{a} {b}" for a, b in zip(words, words[1:], strict=False)}


def signal_words(templates: dict[str, str], dice: Fraction = DICE) -> list[str]:
    """Per template the longest words that together touch more bigrams than a match may lack."""
    signals = set()
    for text in templates.values():
        pairs = bigrams_of(text)
        most_missing = len(pairs) * (1 - dice / (2 - dice))
        touched: set[str] = set()
        for word in sorted(set(words_of(text)), key=lambda w: (-len(w), w)):
            if len(touched) > most_missing:
                break
            signals.add(word)
            touched |= {p for p in pairs if word in p.split(" ")}
    return sorted(signals)


def _template_bigrams(spark: SparkSession, templates: dict[str, str]) -> DataFrame:
    pairs = {name: sorted(bigrams_of(text)) for name, text in templates.items()}
    rows = [(name, len(own), pair) for name, own in pairs.items() for pair in own]
    return spark.createDataFrame(rows, "license string, template_size int, pair string")


def _bigrams(segment: Column) -> Column:
    words = F.regexp_extract_all(F.lower(segment), F.lit("[a-z0-9]+"), F.lit(0))
    return F.array_distinct(
        F.zip_with(
            F.slice(words, F.lit(1), F.greatest(F.size(words) - 1, F.lit(0))),
            F.slice(words, F.lit(2), F.greatest(F.size(words) - 1, F.lit(0))),
            lambda a, b: F.concat_ws(" ", a, b),
        )
    )


def license_matches(docs: DataFrame, templates: dict[str, str] = TEMPLATES, dice: Fraction = DICE) -> tuple[DataFrame, DataFrame]:
    """(documents: doc_id, row) and (matches: row, unit, n, license, common, segment_size, template_size)."""
    spark = docs.sparkSession
    sizes = [len(bigrams_of(t)) for t in templates.values()]
    low, high = dice / (2 - dice), (2 - dice) / dice
    least, most = min(sizes) * low, max(sizes) * high
    signals = rf"(?i)(?<![a-z0-9])(?:{'|'.join(signal_words(templates, dice))})(?![a-z0-9])"
    text = whole_text()
    rows = docs.select(
        "doc_id",
        F.monotonically_increasing_id().alias("row"),
        F.when(text.rlike(signals), text).alias("text"),
    )
    rows = stored(rows, "license-texts")  # only texts with a signal word are written
    cut = {
        "line": F.split("text", r"\n", -1),
        "paragraph": F.split("text", r"\n[ \t\r]*\n", -1),
        "text": F.array("text"),
    }
    units = [F.transform(parts, lambda s, u=unit: F.struct(F.lit(u).alias("unit"), s.alias("segment"))) for unit, parts in cut.items()]
    segments = rows.where("text IS NOT NULL").select("row", F.posexplode(F.concat(*units)).alias("n", "part"))
    segments = segments.select("row", "n", "part.unit", "part.segment").where(F.col("segment").rlike(signals))
    segments = segments.select("row", "n", "unit", _bigrams(F.col("segment")).alias("pairs"))
    segments = segments.withColumn("segment_size", F.size("pairs"))
    segments = segments.where(F.col("segment_size").between(float(least), float(most)))
    pairs = segments.select("row", "n", "unit", "segment_size", F.explode("pairs").alias("pair"))
    # A template table of a few hundred rows; its size bounds sit in the join.
    known = F.broadcast(_template_bigrams(spark, templates))
    near = (F.col("segment_size") >= F.col("template_size") * float(low) - 1e-9) & (
        F.col("segment_size") <= F.col("template_size") * float(high) + 1e-9
    )
    hits = pairs.join(known, "pair").where(near)
    hits = hits.groupBy("row", "n", "unit", "license", "segment_size", "template_size").agg(F.count("*").alias("common"))
    score = 2 * dice.denominator * F.col("common")
    hits = hits.where(score >= dice.numerator * (F.col("segment_size") + F.col("template_size")))
    # One segment may be a line, a paragraph and the text at once: the smallest unit counts (they come first).
    hits = hits.withColumn("dice", 2.0 * F.col("common") / (F.col("segment_size") + F.col("template_size")))
    best = Window.partitionBy("row", "n").orderBy(F.desc("dice"), "license")
    hits = hits.withColumn("place", F.row_number().over(best)).where("place = 1").drop("place")
    return rows.select("doc_id", "row"), hits


def scan(docs: DataFrame, templates: dict[str, str] = TEMPLATES, dice: Fraction = DICE) -> DataFrame:
    """One row per document: doc_id, licenses (sorted distinct names), n_matches, best (highest coefficient or null)."""
    rows, hits = license_matches(docs, templates, dice)
    found = hits.groupBy("row").agg(
        F.sort_array(F.collect_set("license")).alias("licenses"),
        F.count("*").alias("n_matches"),
        F.max("dice").alias("best"),
    )
    return rows.join(found, "row", "left").select(
        "doc_id",
        F.coalesce("licenses", F.array().cast("array<string>")).alias("licenses"),
        F.coalesce("n_matches", F.lit(0)).cast("long").alias("n_matches"),
        "best",
    )
