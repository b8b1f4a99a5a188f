"""Licences of files: sparse TF-IDF cosine to templates, then inheritance from the nearest directory.

DataFrame functions only. Header lines (lines with a licence marker) of every file are compared
with licence templates; term weights come from all distinct header lines and the templates. A file
without a header of its own takes the licence of the nearest directory above it that has a licence
file, found by joining directories with their ancestors.

Defined cases: null or empty texts have no header; a null path has no directory and inherits
nothing; equal scores go to the template that is first by name; a directory with several licence
files takes the best score, then the first name; repeated rows give repeated results; an empty
table gives an empty table; extra columns are kept out.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerflow.llm.common import stash

MIN_COSINE = 0.6
MARKER = r"(?i)licen[sc]e|copyright|rights reserved|permission is hereby|redistribution and use|spdx"
TERM = "[a-z0-9]+(?:[.-][a-z0-9]+)*"
LICENCE_FILE = r"(?i)^(licen[sc]e|copying|unlicense|notice)([.-].*)?$"

# Notices of common licences.
TEMPLATES = [
    ("all-rights-reserved", "All rights reserved."),
    ("apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("bsd-3-clause", "Redistribution and use in source and binary forms, with or without modification, are permitted"),
    ("cc-by-4.0", "Licensed under CC BY 4.0."),
    ("cc-by-nc-4.0", "Licensed under CC BY-NC 4.0."),
    ("cc-by-sa-4.0", "Licensed under CC BY-SA 4.0."),
    ("gpl-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("gpl-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("lgpl-3.0", "This work is licensed under the GNU Lesser General Public License, version 3."),
    ("mit", "Released under the MIT License."),
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software"),
    ("mpl-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
]


def _terms(text: Column) -> Column:
    return F.regexp_extract_all(F.lower(text), F.lit(TERM), F.lit(0))


def header_scores(lines: DataFrame, spark: SparkSession) -> DataFrame:
    """(line, license, score): the best template of each distinct header line, if near enough."""
    templates = spark.createDataFrame([(i, n, t) for i, (n, t) in enumerate(TEMPLATES)], "no int, license string, line string")
    counted = lines.select("line", F.explode(_terms(F.col("line"))).alias("term")).groupBy("line", "term").agg(
        F.count(F.lit(1)).alias("tf"))
    t_counted = templates.select("no", "license", F.explode(_terms(F.col("line"))).alias("term")).groupBy(
        "no", "license", "term").agg(F.count(F.lit(1)).alias("tf"))
    # Document frequencies over distinct header lines and templates; the number of both is one row.
    vectors = counted.select("term").unionByName(t_counted.select("term"))
    frequency = vectors.groupBy("term").agg(F.count(F.lit(1)).alias("df"))
    n = lines.count() + len(TEMPLATES)
    weights = frequency.select("term", (F.log(F.lit(float(1 + n)) / (1 + F.col("df"))) + 1).alias("idf"))
    w = counted.join(weights, "term").select("line", "term", (F.col("tf") * F.col("idf")).alias("w"))
    tw = t_counted.join(weights, "term").select("no", "license", "term", (F.col("tf") * F.col("idf")).alias("tw"))
    norms = w.groupBy("line").agg(F.sqrt(F.sum(F.col("w") * F.col("w"))).alias("norm"))
    t_norms = tw.groupBy("no").agg(F.sqrt(F.sum(F.col("tw") * F.col("tw"))).alias("t_norm"))
    dots = w.join(tw, "term").groupBy("line", "no", "license").agg(F.sum(F.col("w") * F.col("tw")).alias("dot"))
    cosine = (dots.join(norms, "line").join(t_norms, "no")
              .withColumn("score", F.round(F.col("dot") / (F.col("norm") * F.col("t_norm")), 6))
              .filter(F.col("score") >= MIN_COSINE))
    best = F.min(F.struct((-F.col("score")).alias("s"), "license"))
    return cosine.groupBy("line").agg(best.alias("b")).select(
        "line", F.col("b.license").alias("license"), (-F.col("b.s")).alias("score"))


def _header_lines(text: Column) -> Column:
    trimmed = F.transform(F.split(text, "\n", -1), lambda line: F.trim(line))
    return F.array_distinct(F.filter(trimmed, lambda line: line.rlike(MARKER)))


def _directory(path: Column) -> Column:
    return F.regexp_replace(path, "/?[^/]*$", "")


def scan_licenses(files: DataFrame, path_col: str = "path", text_col: str = "text", id_col: str = "doc_id") -> DataFrame:
    """(doc_id, path, license, score, via, found_in) of every file.

    ``via`` is ``header``, ``inherited`` or ``none``; ``found_in`` is the file's own path or the
    directory whose licence file it follows.
    """
    spark = files.sparkSession
    # Written once without the texts: what follows reads it several times, the texts are read once.
    rows = stash(files.select(
        F.col(id_col).alias("doc_id"), F.col(path_col).alias("path"),
        F.when(F.col(text_col).rlike(MARKER), _header_lines(F.col(text_col))).alias("headers"),
        F.monotonically_increasing_id().alias("row")), "license-headers")
    headers = rows.select("row", F.explode("headers").alias("line"))
    scores = header_scores(headers.select("line").distinct(), spark)
    own = headers.join(scores, "line").groupBy("row").agg(
        F.min(F.struct((-F.col("score")).alias("s"), "license")).alias("own"))
    judged = rows.drop("headers").join(own, "row", "left").withColumn("dir", _directory(F.col("path")))
    licence_files = judged.filter(F.col("own").isNotNull()
                                  & F.regexp_extract("path", "[^/]*$", 0).rlike(LICENCE_FILE))
    by_dir = licence_files.groupBy(F.col("dir").alias("ancestor")).agg(F.min("own").alias("theirs"))
    dirs = judged.filter(F.col("own").isNull() & F.col("dir").isNotNull()).select("dir").distinct()
    parts = F.split("dir", "/")
    ancestors = dirs.select("dir", F.posexplode(F.transform(
        F.sequence(F.size(parts), F.lit(0), F.lit(-1)), lambda i: F.array_join(F.slice(parts, 1, i), "/"))).alias("up", "ancestor"))
    nearest = ancestors.join(by_dir, "ancestor").groupBy("dir").agg(
        F.min(F.struct("up", "theirs", "ancestor")).alias("near"))
    found = judged.join(nearest.withColumnRenamed("dir", "near_dir"), F.col("dir") == F.col("near_dir"), "left")
    has_own = F.col("own").isNotNull()
    near = F.when(~has_own, F.col("near"))
    picked = F.coalesce(F.col("own"), near["theirs"])
    return found.select(
        "doc_id", "path", picked["license"].alias("license"), (-picked["s"]).alias("score"),
        F.when(has_own, "header").when(near.isNotNull(), "inherited").otherwise("none").alias("via"),
        F.when(has_own, F.col("path")).otherwise(near["ancestor"]).alias("found_in"))


def document_paths(docs: DataFrame) -> DataFrame:
    """Documents as files of their source: folders of 1,000 and 100 ids, each hundredth a LICENSE file."""
    i = F.col("doc_id")
    name = F.when(i % 100 == 0, F.lit("LICENSE")).otherwise(F.concat(i.cast("string"), F.lit(".txt")))
    folder = F.when(i % 1000 == 0, F.lit("")).otherwise(
        F.concat(F.floor(i / 1000).cast("string"), F.lit("/"), F.floor(i / 100).cast("string"), F.lit("/")))
    return docs.select("doc_id", "text", F.concat(F.col("source"), F.lit("/"), folder, name).alias("path"))
