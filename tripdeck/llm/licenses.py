"""License scan: MinHash bands over overlapping text windows, then exact containment.

All of it is DataFrame expressions. Texts and license templates become sequences of hashes of
three neighbouring words. A window class of width w serves the templates with at most w / 2 such
shingles; windows begin every w / 2 shingles, so such a template lies whole in some window, with a Jaccard similarity of at
least a quarter (of a half and more for most). Each of ``bands`` MinHash values of a window is
looked up among the templates' values of that class: a template that is whole in a window
is missed with a probability of at most 0.75 ** bands. A value can only be equal if the shingle
that gives it is one of the template's least, so windows without any of those are passed over.
Retrieved templates are verified by the exact share of their shingles that the window holds.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tripdeck.llm.stages import written

# Short license notices as they are commonly written, by SPDX-like name.
TEMPLATES = (
    ("agpl-3.0", "This program is free software: you can redistribute it and/or modify it under "
                 "the terms of the GNU Affero General Public License"),
    ("all-rights-reserved", "All rights reserved."),
    ("apache-2.0", "Licensed under the Apache License, Version 2.0"),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, "
            "are permitted provided that the following conditions are met"),
    ("cc-by-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International "
                  "License"),
    ("cc-by-nc-4.0", "Licensed under CC BY-NC 4.0."),
    ("cc-by-sa-4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 "
                     "International License"),
    ("gpl-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("mit", "Released under the MIT License."),
    ("mit-permission", "Permission is hereby granted, free of charge, to any person obtaining a "
                       "copy of this software and associated documentation files"),
    ("mpl-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, "
                "v. 2.0"),
)
NARROWEST = 4
LITERAL_SHINGLES = 50_000  # least shingles that one pass carries as a constant


def template_table(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(list(TEMPLATES), "license string, text string")


def _shingles(text: Column) -> Column:
    """Hashes of three neighbouring words (letters and digits, lower case), in text order."""
    words = F.filter(F.split(F.lower(text), r"[^\p{L}\p{N}]+"), lambda w: w != "")

    def behind(n):
        return F.slice(words, n + 1, F.greatest(F.size(words) - n, F.lit(0)))
    two = F.zip_with(words, behind(1), lambda a, b: F.when(b.isNotNull(), F.xxhash64(a, b)))
    return F.array_compact(F.zip_with(two, behind(2), lambda h, c: F.when(
        c.isNotNull(), F.xxhash64(h, c))))


def _least(shingles: Column, bands: int) -> Column:
    """For each band the shingle of least hash there, as (band, shingle)."""
    return F.transform(F.sequence(F.lit(1), F.lit(bands)), lambda k: F.struct(
        k.alias("band"), F.array_min(F.transform(shingles, lambda h: F.struct(
            F.xxhash64(h, k).alias("rank"), h.alias("shingle"))))["shingle"].alias("shingle")))


def scan_licenses(docs: DataFrame, templates: DataFrame, bands: int = 32,
                  containment: float = 0.8) -> DataFrame:
    """(doc_id, license, containment, first_word, windows): templates found in each document.

    A template is found if some window holds the share ``containment`` of its distinct
    shingles; the best share, the word index at which the first such window begins, and the number
    of such windows are given. Null texts, and texts or templates of fewer than three words, have
    no matches. Rows with a null doc_id or license are left out; rows that share a doc_id are one
    document, templates of one name are one license. Extra columns are ignored. Templates are
    taken in as many passes as their least shingles need to fit a constant.
    """
    library = (templates.where("license is not null and text is not null")
               .select(F.col("license").cast("string").alias("license"),
                       F.array_distinct(_shingles(F.col("text"))).alias("held"))
               .where("size(held) > 0")
               .withColumn("template", F.xxhash64("license", "held"))
               .dropDuplicates(["template"])
               .withColumn("width", F.greatest(F.lit(NARROWEST), F.pow(
                   F.lit(2.0), F.ceil(F.log2(2 * F.size("held")))).cast("int")))
               .withColumn("least", _least(F.col("held"), bands)))
    library = written(library, "license-templates")
    count = library.count()
    passes = max(1, -(-count * bands // LITERAL_SHINGLES))
    texts = (docs.where("doc_id is not null")
             .select(F.col("doc_id").cast("long").alias("doc_id"),
                     _shingles(F.coalesce(F.col("text").cast("string"), F.lit("")))
                     .alias("shingles")))
    found = None
    for k in range(passes if count else 0):
        part = library.where(F.pmod("template", F.lit(passes)) == k)
        # bounded by LITERAL_SHINGLES, up to the evenness of the hash
        least = [r["shingle"] for r in part.select(F.explode("least.shingle").alias("shingle"))
                 .distinct().collect()]
        widths = sorted(r["width"] for r in part.select("width").distinct().collect())
        if not least:
            continue
        known = F.lit(least)
        near = (texts.where(F.arrays_overlap("shingles", known))
                .withColumn("hits", F.filter(F.transform(
                    "shingles", lambda h, i: F.when(F.array_contains(known, h), i)),
                    lambda i: i.isNotNull())))

        def windows(width):
            step = width // 2
            starts = F.array_distinct(F.flatten(F.transform("hits", lambda i: F.filter(
                F.array(F.floor(i / step) * step, F.floor(i / step) * step - step),
                lambda s: s >= 0))))
            return F.transform(starts, lambda s: F.struct(
                F.lit(width).alias("width"), s.cast("int").alias("start"),
                F.array_distinct(F.slice("shingles", s.cast("int") + 1, width)).alias("window")))
        rows = near.select("doc_id", F.inline(F.flatten(F.array(*map(windows, widths)))))
        keys = part.select("license", "template", "held", "width", F.inline("least"))
        hit = (rows.withColumn("of", F.explode(_least(F.col("window"), bands)))
               .select("doc_id", "width", "start", "window", "of.*")
               .join(F.broadcast(keys), ["width", "band", "shingle"])
               .withColumn("share", F.size(F.array_intersect("held", "window"))
                           / F.size("held"))
               .where(F.col("share") >= containment)
               .select("doc_id", "license", "width", "start", "share"))
        found = hit if found is None else found.union(hit)
    if found is None:
        return docs.sparkSession.createDataFrame(
            [], "doc_id long, license string, containment double, first_word int, windows long")
    return found.groupBy("doc_id", "license").agg(
        F.round(F.max("share"), 6).alias("containment"), F.min("start").alias("first_word"),
        F.countDistinct("width", "start").alias("windows"))
