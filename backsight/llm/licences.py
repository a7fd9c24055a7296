"""Licence scans: TF-IDF cosine of headers and licence files to templates, then inheritance from the nearest directory.

A segment is a line of a text with a licence word in it, or the whole text of a licence file. Equal segments are scored
once: their words are weighted by tf * idf, with document frequencies over the distinct segments of the whole table, and
equi-joined to the words of the templates. The best template at or above ``least`` is the segment's licence; a file's own
licence is its best segment's. A licence file's licence holds for its directory; a file without one of its own takes
that of its nearest ancestor directory, found by joining all its ancestor paths to the licensed directories.

DataFrame functions only. Cases: a null text has no segments; a null path inherits nothing; ties go to the name that
sorts first; repeated rows each get a row; an empty table gives an empty one; ``files`` may have any other columns.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from backsight.llm.components import write

#: The usual notices of public licences.
TEMPLATES = {
    "AGPL-3.0": ["This work is licensed under the GNU Affero General Public License, version 3."],
    "Apache-2.0": ["Licensed under the Apache License, Version 2.0."],
    "BSD-3-Clause": [
        "Released under the BSD 3-Clause License.",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met",
    ],
    "CC-BY-4.0": ["Licensed under CC BY 4.0.", "This work is licensed under a Creative Commons Attribution 4.0 International License."],
    "CC-BY-NC-4.0": ["Licensed under CC BY-NC 4.0.", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."],
    "CC-BY-SA-4.0": ["Licensed under CC BY-SA 4.0.", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."],
    "GPL-2.0": ["This work is licensed under the GNU General Public License, version 2."],
    "GPL-3.0": ["This work is licensed under the GNU General Public License, version 3."],
    "LGPL-3.0": ["This work is licensed under the GNU Lesser General Public License, version 3."],
    "MIT": [
        "Released under the MIT License.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files",
    ],
    "MPL-2.0": ["This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."],
}
ANCHOR = "(?i)licen[cs]e|copyright|redistribution|permission is"
WORD = "[a-z0-9]+(?:[.-][a-z0-9]+)*"
LICENCE_FILE = "(?i)(^|/)(licen[cs]e|copying|notice)([.][^/]*)?$"


def _words(text: Column) -> Column:
    return F.regexp_extract_all(F.lower(text), F.lit(f"({WORD})"))


def segments(files: DataFrame, path: str, text: str) -> DataFrame:
    """(number, path, segments): a number for each row and its distinct segments, words and their digest."""
    value = F.coalesce(F.col(text).cast("string"), F.lit(""))
    lines = F.filter(F.split(value, "\n"), lambda x: x.rlike(ANCHOR))
    lines = F.when(value.rlike(ANCHOR), lines).otherwise(F.array().cast("array<string>"))
    whole = F.when(F.coalesce(F.col(path).rlike(LICENCE_FILE), F.lit(False)), F.array(value)).otherwise(F.array().cast("array<string>"))
    joined = F.transform(F.concat(lines, whole), lambda x: F.array_join(_words(x), " "))
    kept = F.transform(F.filter(F.array_distinct(joined), lambda x: x != ""), lambda x: F.struct(F.md5(x.cast("binary")).alias("key"), x.alias("words")))
    return files.select(F.monotonically_increasing_id().alias("number"), F.col(path).cast("string").alias("path"), kept.alias("segments"))


def best_templates(distinct: DataFrame, templates: dict[str, list[str]], least: float) -> DataFrame:
    """(id, licence, score) of the distinct segments (id, words) whose best cosine is ``least`` or more.

    A segment's words stay in the partition of its id until they are joined to their frequencies.
    """
    spark = distinct.sparkSession
    total = distinct.count()
    placed = distinct.select("id", "words").repartition("id")
    terms = placed.select("id", F.explode(F.split("words", " ")).alias("term")).groupBy("id", "term").agg(F.count("*").alias("tf"))
    frequency = terms.groupBy("term").agg(F.count("*").alias("df"))
    idf = F.log((F.lit(float(total)) + 1) / (F.coalesce("df", F.lit(0)) + 1)) + 1
    weighted = terms.join(frequency, "term").select("id", "term", (F.col("tf") * idf).alias("w"))
    norms = weighted.groupBy("id").agg(F.sqrt(F.sum(F.col("w") * F.col("w"))).alias("norm"))
    known = spark.createDataFrame([(name, f"{name}/{k}", t) for name, texts in sorted(templates.items()) for k, t in enumerate(texts)], "licence string, template string, text string")
    known = known.select("licence", "template", F.explode(_words(F.col("text"))).alias("term")).groupBy("licence", "template", "term").agg(F.count("*").alias("tf"))
    known = known.join(frequency, "term", "left").select("licence", "template", "term", (F.col("tf") * idf).alias("t"))
    # The templates are fixed values, so their words have a fixed bound.
    own = known.groupBy("template").agg(F.sqrt(F.sum(F.col("t") * F.col("t"))).alias("own"))
    known = known.join(F.broadcast(own), "template")
    products = weighted.join(F.broadcast(known), "term").groupBy("id", "licence", "template", "own").agg(F.sum(F.col("w") * F.col("t")).alias("dot"))
    scored = products.join(norms, "id").select("id", "licence", F.round(F.col("dot") / (F.col("norm") * F.col("own")), 6).alias("score"))
    scored = scored.where(F.col("score") >= least).groupBy("id").agg(F.min(F.struct((-F.col("score")).alias("s"), "licence")).alias("best"))
    return scored.select("id", F.col("best.licence").alias("licence"), (-F.col("best.s")).alias("score"))


def _best(*group: str):
    """The licence of the greatest score, ties to the first name, within each group."""
    return lambda df: df.groupBy(*group).agg(F.min(F.struct((-F.col("score")).alias("s"), "licence")).alias("best")).select(*group, F.col("best.licence").alias("licence"), (-F.col("best.s")).alias("score"))


def scan(files: DataFrame, path: str = "path", text: str = "text", templates: dict[str, list[str]] | None = None, least: float = 0.8) -> DataFrame:
    """(path, own_licence, own_score, licence, licensed_by): one row per row; ``licensed_by`` is the directory inherited from."""
    rows, _ = write(segments(files, path, text), "licence-segments")
    each = rows.select("number", F.explode("segments").alias("segment")).select("number", "segment.key", "segment.words")
    distinct = each.groupBy("key").agg(F.min("words").alias("words")).withColumn("id", F.monotonically_increasing_id())
    distinct, _ = write(distinct, "distinct-segments")
    best, _ = write(best_templates(distinct, templates or TEMPLATES, least).join(distinct.select("id", "key"), "id"), "licence-templates")
    own, _ = write(_best("number")(each.select("number", "key").join(best.select("key", "licence", "score"), "key")), "own-licences")
    marked = rows.select("number", "path").join(own, "number", "left")
    cut = F.regexp_replace("path", "[^/]*$", "")
    directories = _best("directory")(marked.where(F.col("path").rlike(LICENCE_FILE) & F.col("licence").isNotNull()).withColumn("directory", cut))
    directories = directories.select("directory", F.col("licence").alias("given"))
    # All ancestors of a path: 'a/b/c' lies in 'a/b/', 'a/' and ''.
    steps = F.split(cut, "(?<=/)")
    ancestors = F.transform(F.sequence(F.lit(0), F.size(steps)), lambda k: F.array_join(F.slice(steps, 1, k), ""))
    open_rows = marked.where("licence is null and path is not null").select("number", F.explode(F.array_distinct(ancestors)).alias("directory"))
    inherited = open_rows.join(directories, "directory").groupBy("number")
    inherited = inherited.agg(F.max(F.struct(F.length("directory").alias("depth"), "directory", "given")).alias("near"))
    found = marked.join(inherited, "number", "left")
    return found.select(
        "path", F.col("licence").alias("own_licence"), F.col("score").alias("own_score"),
        F.coalesce("licence", "near.given").alias("licence"), F.col("near.directory").alias("licensed_by"),
    )
