"""License scans with DataFrame functions only.

A text's five-word shingles are hashed once.  Overlapping windows over them
that touch a template are MinHashed, and windows whose bands meet a template's
bands retrieve it; exact containment of the template's shingles in the window
then decides.

A template of s shingles is looked for in windows of 2s shingles that start
every s, so each of its occurrences lies whole in a window.  Bands have one
row: at a containment of 0.8 the similarity is 0.8s / 2.2s or more, and
``BANDS`` = 32 bands meet with a probability over 0.999999.  A window without
any shingle of a template can meet none of its bands, which is why those that
touch none are passed over before the MinHash."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

WORDS = 5
BANDS = 32
CONTAINMENT = 0.8
MAX_TEMPLATES = 1000     # the templates' bands are broadcast: 32 rows each

# Notices as the licences' publishers word them.
TEMPLATES = [
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
            "associated documentation files"),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL", "This program is free software: you can redistribute it and/or modify it under the terms of the "
            "GNU General Public License as published by the Free Software Foundation"),
    ("BSD", "Redistribution and use in source and binary forms, with or without modification, are permitted "
            "provided that the following conditions are met"),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License"),
]
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def words(text: Column) -> Column:
    """Runs of letters and digits, A-Z lower-cased."""
    return F.filter(F.split(F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER), r"[^\p{L}\p{N}]+"), lambda w: w != "")


def let(value: Column, body) -> Column:
    """``body(value)`` with the value computed once: a filter or projection
    that refers to a column many times would otherwise repeat it."""
    return F.transform(F.array(value), body)[0]


def shingles(word_list: Column) -> Column:
    """Hashes of all runs of five words, in order; none for shorter lists."""
    def runs(w: Column) -> Column:
        last = F.size(w) - WORDS
        run = lambda i: F.xxhash64(*[F.get(w, i + j) for j in range(WORDS)])
        return F.when(last >= 0, F.transform(F.sequence(F.lit(0), F.greatest(last, F.lit(0))), run)).otherwise(
            F.array().cast("array<bigint>"))

    return let(word_list, runs)


def band_values(hashes: Column) -> Column:
    """One MinHash value per band."""
    return F.transform(F.sequence(F.lit(1), F.lit(BANDS)),
                       lambda b: F.array_min(F.transform(hashes, lambda h: F.xxhash64(h, b))))


def template_table(spark: SparkSession, templates: list[tuple[str, str]]) -> DataFrame:
    """(template, license, shingles, s) of the given notices."""
    if len(templates) > MAX_TEMPLATES:
        raise ValueError(f"at most {MAX_TEMPLATES} templates")
    rows = spark.createDataFrame([(i, name, text) for i, (name, text) in enumerate(templates)],
                                 "template int, license string, text string")
    return (rows.withColumn("w", words(F.col("text"))).withColumn("shingles", F.array_distinct(shingles(F.col("w"))))
            .withColumn("s", F.size("shingles")).drop("w", "text"))


def scan(docs: DataFrame, templates: list[tuple[str, str]] | None = None, id_col: str = "doc_id",
         text_col: str = "text") -> DataFrame:
    """(id, license, template, n_template, n_shared, n_windows, first_word):
    one row per document and template that is contained to ``CONTAINMENT`` or
    more in one of the document's windows; the most shared shingles, the number
    of such windows and the first word of the first.

    Texts are read whole.  Null, empty and shorter texts match nothing.  Rows
    that repeat an id are scanned together: equal windows count once.  An empty
    table gives no rows; extra columns of any name are ignored.  Templates need
    five words at least."""
    spark = docs.sparkSession
    known = template_table(spark, TEMPLATES if templates is None else templates)
    table = known.collect()                                           # the given list, not data
    if any(t["s"] == 0 for t in table):
        raise ValueError("a template has fewer than five words")
    wanted = F.array(*[F.lit(h) for h in sorted({h for t in table for h in t["shingles"]})])
    touches = lambda h: F.arrays_overlap(h, wanted)
    hashed = docs.select(F.col(id_col).alias("id"),
                         F.explode(F.filter(F.array(shingles(words(F.col(text_col)))), touches)).alias("hashes"))
    sizes = F.array(*[F.lit(s) for s in sorted({t["s"] for t in table})])
    window = lambda start, s: F.struct(
        s.alias("s"), start.alias("start"), F.array_distinct(F.slice("hashes", start + 1, 2 * s)).alias("window"))
    windows = (hashed.select("id", "hashes", F.explode(sizes).alias("s"))
               .select("id", F.explode(F.filter(
                   F.transform(F.sequence(F.lit(0), F.size("hashes") - 1, F.col("s")), lambda x: window(x, F.col("s"))),
                   lambda x: touches(x["window"]))).alias("x"))
               .select("id", "x.*"))
    banded = windows.select("id", "s", "start", "window", F.posexplode(band_values(F.col("window"))).alias("band", "value"))
    bands = known.select("template", "license", "s", "shingles", F.posexplode(band_values(F.col("shingles"))).alias("band", "value"))
    met = banded.join(F.broadcast(bands), ["s", "band", "value"])
    shared = F.size(F.array_intersect("window", "shingles"))
    return (met.withColumn("shared", shared).where(F.col("shared") >= CONTAINMENT * F.col("s"))
            .groupBy("id", "license", "template")
            .agg(F.max(F.col("s")).cast("long").alias("n_template"), F.max("shared").cast("long").alias("n_shared"),
                 F.countDistinct("start").alias("n_windows"), F.min("start").cast("long").alias("first_word")))
