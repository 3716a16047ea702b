"""License scans: normalised text against license templates by the Dice coefficient over word bigrams.

A text is put in lower case, everything but letters, digits and line ends becomes a space, and its lines, and paragraphs
of more than one line, are the parts to compare. With n and m distinct bigrams and c in common, Dice is 2c / (n + m). As
c is at most the smaller of n and m, a template is a candidate only for parts with m t / (2 - t) <= n <= m (2 - t) / t.

Parts outside the bounds of all templates fall before their bigrams are looked up. The bigrams of the others meet those
of the templates in a hash join in which the bounds of the very template stand as a condition; what is grouped afterwards
are the few bigrams that matched.

Defined results: a null or empty text has no findings. A part that is as like to several templates is given to the first
by name. A document has one row for each part that is found; copies each have their own. Repeated lines are found each.
Rows with a null id are searched like others. Other columns are not read.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from .common import whole

#: Least Dice coefficient.
LEAST = 0.8
#: Bigrams of all templates up to which their table may be sent to every task.
MOST_BIGRAMS = 200_000

# License names and the wording of their public notices.
TEMPLATES = [
    ("All-Rights-Reserved", "All rights reserved."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance "
                   "with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0"),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that "
                     "the following conditions are met:"),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0-or-later", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
                         "Public License as published by the Free Software Foundation, either version 3 of the License, or (at your "
                         "option) any later version."),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
            "documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the "
            "rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit "
            "persons to whom the Software is furnished to do so, subject to the following conditions:"),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
]


def normalised(text: Column) -> Column:
    return F.regexp_replace(F.lower(text), "[^\\p{L}\\p{N}\\n]+", " ")


def bigrams(words: Column) -> Column:
    """The distinct pairs of adjacent words. The array around ``words`` keeps it from being worked out for every pair."""
    def pairs(own: Column) -> Column:
        return F.array_distinct(F.transform(F.slice(own, 2, F.size(own)), lambda w, i: F.concat_ws(" ", F.get(own, i), w)))

    return F.transform(F.array(words), pairs)[0]


def template_bigrams(templates: list[tuple[str, str]]) -> list[tuple[str, int, str, int]]:
    """(bigram, template number, license, number of bigrams in the template)."""
    out = []
    for k, (name, wording) in enumerate(templates):
        words = re.sub(r"[\W_]+", " ", wording.lower()).split()
        grams = dict.fromkeys(" ".join(p) for p in zip(words, words[1:]))
        out += [(g, k, name, len(grams)) for g in grams]
    return out


def parts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, row, part, position, words: lines by number, and paragraphs of several lines by number."""
    rows = docs.select(F.col(id_col).alias("doc_id"), F.monotonically_increasing_id().alias("row"), normalised(whole(F.col(text_col))).alias("text"))
    lines = F.transform(F.split("text", "\n"), lambda x, i: F.struct(F.lit("line").alias("part"), i.alias("position"), x.alias("words")))
    blocks = F.transform(F.split("text", "\n[ \n]*\n"), lambda x, i: F.struct(F.lit("paragraph").alias("part"), i.alias("position"), x.alias("words")))
    several = F.filter(blocks, lambda x: F.contains(F.btrim(x["words"], F.lit(" \n")), F.lit("\n")))
    found = rows.select("doc_id", "row", F.explode(F.concat(lines, several)).alias("x")).select("doc_id", "row", "x.*")
    return found.withColumn("words", F.filter(F.split(F.translate("words", "\n", " "), " "), lambda w: w != ""))


def scan(docs: DataFrame, templates: list[tuple[str, str]] = TEMPLATES, least: float = LEAST, id_col: str = "doc_id",
         text_col: str = "text") -> DataFrame:
    """One row per part that is like a template: doc_id, part, position, license, dice."""
    spark: SparkSession = docs.sparkSession
    grams = template_bigrams(templates)
    table = spark.createDataFrame(grams, "gram string, template int, license string, m int")
    if len(grams) <= MOST_BIGRAMS:
        table = F.broadcast(table)
    sizes = [g[3] for g in grams]
    low, high = min(sizes) * least / (2 - least), max(sizes) * (2 - least) / least
    # distinct bigrams are never more than words; whether they are few enough is known only when they are counted
    sized = parts(docs, id_col, text_col).filter(F.size("words") > low).withColumn("grams", bigrams(F.col("words"))).drop("words")
    sized = sized.withColumn("n", F.size("grams")).filter(F.col("n").between(low - 1e-9, high + 1e-9))
    fits = (F.col("n") >= F.col("m") * least / (2 - least) - 1e-9) & (F.col("n") <= F.col("m") * (2 - least) / least + 1e-9)
    met = sized.select("doc_id", "row", "part", "position", "n", F.explode("grams").alias("_gram")).join(
        table, (F.col("_gram") == F.col("gram")) & fits)
    like = met.groupBy("doc_id", "row", "part", "position", "n", "template", "license", "m").agg(F.count("*").alias("c")).withColumn(
        "dice", 2 * F.col("c") / (F.col("n") + F.col("m"))).filter(F.col("dice") >= least)
    best = Window.partitionBy("row", "part", "position").orderBy(F.col("dice").desc(), "license", "template")
    return like.withColumn("place", F.row_number().over(best)).filter("place = 1").select("doc_id", "part", "position", "license", "dice")
