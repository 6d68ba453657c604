"""License scans: TF-IDF cosine of lines and licence files to templates, inherited by directory."""

from __future__ import annotations

import regex
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tabforge.session import checkpoint

#: Possessive, so that a long chain of terms is matched without recursion.
TERM = r"[\p{L}\p{N}]++(?:[.+-][\p{L}\p{N}]++)*+"

#: Notices by which files state their licence, by SPDX identifier.
TEMPLATES = (
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this "
            "software and associated documentation files, to deal in the Software without restriction."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the License); you may not use "
                   "this file except in compliance with the License."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "This program is free software: you can redistribute it and/or modify it under the "
                "terms of the GNU General Public License as published by the Free Software "
                "Foundation, either version 3 of the License, or any later version."),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("LGPL-3.0", "This work is licensed under the GNU Lesser General Public License, version 3."),
    ("AGPL-3.0", "This work is licensed under the GNU Affero General Public License, version 3."),
    ("BSD-3-Clause", "Licensed under the BSD 3-Clause License."),
    ("BSD-2-Clause", "Licensed under the BSD 2-Clause License."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC0-1.0", "Released under CC0 1.0 Universal public domain dedication."),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
)


def terms(text: Column) -> Column:
    return F.regexp_extract_all(F.lower(text), F.lit(f"({TERM})"), F.lit(1))


def template_terms(templates=TEMPLATES) -> list[str]:
    """The distinct terms of all templates, a fixed vocabulary."""
    return sorted({t for _, text in templates for t in regex.findall(TERM, text.lower())})


def template_weights(counted: DataFrame, n_files: int, templates=TEMPLATES) -> DataFrame:
    """``(template, license, term, tf, idf, w, tnorm)``: TF-IDF of the templates, by the document
    frequencies ``(term, df)`` that were counted over all files."""
    rows = counted.sparkSession.createDataFrame(
        [(i, lic, text) for i, (lic, text) in enumerate(templates)],
        "template int, license string, text string")
    tf = (rows.select("template", "license", F.explode(terms(F.col("text"))).alias("term"))
          .groupBy("template", "license", "term").agg(F.count(F.lit(1)).alias("tf")))
    weighted = (tf.join(counted, "term", "left")
                .withColumn("idf", F.log((n_files + 1) / (F.coalesce("df", F.lit(0)) + 1)) + 1)
                .withColumn("w", F.col("tf") * F.col("idf")))
    norm = F.sqrt(F.sum(F.col("w") * F.col("w")).over(Window.partitionBy("template")))
    return weighted.withColumn("tnorm", norm).select(
        "template", "license", "term", "tf", "idf", "w", "tnorm")


def line_weights(lines: DataFrame, rows: DataFrame, n_files: int) -> DataFrame:
    """``(term, df, line_idf)`` of the terms of ``lines``, counted over all files."""
    needed = lines.select(F.explode(F.array_distinct("terms")).alias("term")).distinct()
    counted = (rows.select(F.explode(F.array_distinct(terms(F.col("_text")))).alias("term"))
               .groupBy("term").agg(F.count(F.lit(1)).alias("df")))
    return (counted.join(needed, "term", "left_semi")
            .withColumn("line_idf", F.log((n_files + 1) / (F.col("df") + 1)) + 1))


def directory(path: Column) -> Column:
    """The path without its last part ('' at the top)."""
    return F.regexp_replace(path, r"/?[^/]*$", "")


def ancestors(folder: Column) -> Column:
    """The folder itself and all above it, the top ('') included."""
    parts = F.split(folder, "/")
    return F.when(folder == "", F.array(F.lit(""))).otherwise(F.array_distinct(F.concat(
        F.array(F.lit("")), F.transform(F.sequence(F.lit(1), F.size(parts)),
                                        lambda i: F.array_join(F.slice(parts, 1, i), "/")))))


def file_lines(rows: DataFrame, cues: Column, widest: int) -> DataFrame:
    """``(_k, line, at, n, whole, terms)``: the lines with terms, ``at`` terms into their
    file, that lie within ``widest`` terms of a line with a cue, or in a licence file with one.
    ``whole`` marks the first and last line of a licence file (1 and 2, 3 if there is one line)."""
    near = rows.where(F.arrays_overlap(terms(F.col("_text")), cues))
    near = near.dropDuplicates(["_k"])
    lines = (near.select("_k", "named", F.posexplode(F.split("_text", "\n")).alias("line", "content"))
             .withColumn("terms", terms(F.col("content"))).where(F.size("terms") > 0)
             .select("_k", "named", "line", "terms", F.size("terms").cast("long").alias("n"),
                     F.arrays_overlap("terms", cues).alias("cue")))
    order = Window.partitionBy("_k").orderBy("line")
    upto, rest = order.rowsBetween(Window.unboundedPreceding, 0), order.rowsBetween(0, Window.unboundedFollowing)
    lines = lines.withColumn("at", F.sum("n").over(upto) - F.col("n"))
    lines = lines.withColumns({
        "before": F.max(F.when(F.col("cue"), F.col("at") + F.col("n"))).over(upto),
        "after": F.min(F.when(F.col("cue"), F.col("at"))).over(rest),
        "whole": F.when(F.col("named"), F.lag("line").over(order).isNull().cast("int")
                        + 2 * F.lead("line").over(order).isNull().cast("int")).otherwise(0)})
    close = ((F.col("at") - F.col("before") <= widest)
             | (F.col("after") - F.col("at") - F.col("n") <= widest))
    return lines.where(F.col("named") | close).select("_k", "line", "at", "n", "whole", "terms")


def matching_windows(lines: DataFrame, weights: DataFrame, idf: DataFrame, n_files: int,
                     threshold: float) -> DataFrame:
    """``(_k, line, last, license, score)``: runs of lines, from ``line`` to ``last``, whose cosine
    to a template is ``threshold`` or more.

    A run's dot product is the sum of its lines' and its squared norm at least the sum of theirs, so
    running sums bound its cosine; only runs whose bound reaches the threshold are put together and
    scored.  Only lines that share a term with the template begin or end a run: without one that
    does not, the run scores more."""
    tf = (lines.select("_k", "line", F.explode("terms").alias("term"))
          .groupBy("_k", "line", "term").agg(F.count(F.lit(1)).alias("tf")))
    # Terms of a hundredth of the files are few, however many files there are.
    often = F.col("df") * 100 >= n_files
    common = tf.join(F.broadcast(idf.where(often).select("term", "line_idf")), "term", "left")
    rare = (common.where(F.col("line_idf").isNull()).drop("line_idf")
            .join(idf.where(~often).select("term", "line_idf"), "term"))
    tf = common.where(F.col("line_idf").isNotNull()).unionByName(rare)
    tf = checkpoint(tf.withColumn("lw", F.col("tf") * F.col("line_idf")))
    parts = F.broadcast(weights.select("template", "license", "term", "w", "tnorm", "width"))
    # The terms that a run shares with a template must hold threshold ** 2 of its squared norm.
    covered = (tf.select("_k", "term").distinct().join(parts, "term")
               .groupBy("_k", "template").agg(F.sum(F.col("w") * F.col("w")).alias("held"), F.max("tnorm").alias("tn"))
               .where(F.col("held") >= (F.col("tn") * threshold) ** 2 * 0.999).select("_k", "template"))
    norms = tf.groupBy("_k", "line").agg(F.sum(F.col("lw") * F.col("lw")).alias("n2"))
    placed = (lines.select("_k", "line", "at", "n", "whole").join(norms, ["_k", "line"])
              .withColumn("all2", F.sum("n2").over(Window.partitionBy("_k").orderBy("line"))))
    dots = (tf.join(parts, "term").groupBy("_k", "line", "template", "license", "tnorm", "width")
            .agg(F.sum(F.col("lw") * F.col("w")).alias("dot")).join(covered, ["_k", "template"], "left_semi"))
    dots = dots.join(placed, ["_k", "line"])
    by = Window.partitionBy("_k", "template")
    dots = dots.withColumn("all_dot", F.sum("dot").over(by.orderBy("at")))
    widest = weights.agg(F.max("width")).first()[0] or 0
    ends = F.collect_list(F.struct("line", (F.col("at") + F.col("n")).alias("end"), "all2", "all_dot")
                          ).over(by.orderBy("at").rangeBetween(0, widest))
    runs = (dots.withColumn("ends", ends).withColumn("e", F.explode("ends"))
            .where((F.col("e.line") == F.col("line")) | (F.col("e.end") - F.col("at") <= F.col("width")))
            .withColumn("dots", F.col("e.all_dot") - F.col("all_dot") + F.col("dot"))
            .withColumn("least", F.col("e.all2") - F.col("all2") + F.col("n2"))
            .where(F.col("dots") >= F.sqrt("least") * F.col("tnorm") * threshold * 0.999)
            .select("_k", "template", "line", F.col("e.line").alias("last")))
    totals = (dots.groupBy("_k", "template").agg(F.sum("dot").alias("dots"), F.max("tnorm").alias("tnorm"))
              .join(placed.groupBy("_k").agg(
                  F.sum("n2").alias("least"), F.min(F.when(F.col("whole") % 2 == 1, F.col("line"))).alias("line"),
                  F.max(F.when(F.col("whole") >= 2, F.col("line"))).alias("last")), "_k")
              .where(F.col("line").isNotNull()
                     & (F.col("dots") >= F.sqrt("least") * F.col("tnorm") * threshold * 0.999))
              .select("_k", "template", "line", "last"))
    runs = checkpoint(runs.union(totals).distinct())
    spread = (runs.select("_k", "line", "last").distinct()
              .withColumn("of", F.explode(F.sequence("line", "last"))))
    inner = tf.select("_k", F.col("line").alias("of"), "term", "tf", "lw")
    whole = (spread.join(inner, ["_k", "of"]).groupBy("_k", "line", "last", "term")
             .agg(F.sum("lw").alias("lw")))
    run_norms = whole.groupBy("_k", "line", "last").agg(F.sqrt(F.sum(F.col("lw") * F.col("lw"))).alias("lnorm"))
    run_dots = (runs.withColumn("of", F.explode(F.sequence("line", "last")))
                .join(dots.select("_k", "template", F.col("line").alias("of"), "license", "tnorm", "dot"),
                      ["_k", "template", "of"])
                .groupBy("_k", "line", "last", "template", "license", "tnorm").agg(F.sum("dot").alias("dot")))
    return (run_dots.join(run_norms, ["_k", "line", "last"])
            .select("_k", "line", "last", "license",
                    F.round(F.col("dot") / (F.col("lnorm") * F.col("tnorm")), 9).alias("score"))
            .where(F.col("score") >= threshold))


def scan_licenses(files: DataFrame, id_col: str = "doc_id", path_col: str = "path",
                  text_col: str = "text", threshold: float = 0.8,
                  file_share: float = 0.3, templates=TEMPLATES) -> DataFrame:
    """``(id_col, path, own_license, own_score, own_line, license, inherited_from)`` per file.

    Headers: every line, and every run of lines, of every file is compared with every template by
    the cosine of their TF-IDF vectors, by document frequencies over all files; lines without terms (blank, or comment marks alone) do not
    count.  A run holds at most 1 / threshold ** 2 times as many terms as the template: with more,
    of equal weight, it stays below the threshold.  The best template at ``threshold`` or more is
    the file's own licence (ties: larger score, earlier line, shorter run, licence name), and
    ``own_line`` is where it begins.  Licence files: files named like one (LICENSE, COPYING, ...),
    which are also compared as a whole, or whose matched lines hold ``file_share`` of their terms;
    they license their directory.  The matched lines are those of runs that score best among the
    runs they overlap.  A file without a licence of
    its own takes that of the nearest directory at or above its own that has one, found by
    joining the distinct directories' ancestors; ``inherited_from`` is that directory.  Of several
    licence files in one directory the one of best score, then smallest path and licence, counts.

    Only lines near one that holds a heavy term go on: per template, the lightest terms whose
    weights together stay under ``threshold`` of its norm cannot reach the threshold alone, so a
    run with none of the others is below it.  Tables that are broadcast have a row per template term,
    or per term that a hundredth of the files hold.

    Null paths are the top directory, null and empty texts have no lines that match, repeated rows
    are each reported (they share what is found for their id and path), an empty table gives an
    empty result, and the ids of a table without them are null.
    """
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    ids = F.col(id_col) if id_col in files.columns else F.lit(None).cast("long")
    rows = files.select(ids.alias("_id"), F.coalesce(F.col(path_col), F.lit("")).alias("path"),
                        text.alias("_text"))
    named = F.lower(F.regexp_extract("path", r"([^/]*)$", 1)).rlike(r"^(licen[sc]e|copying|notice|unlicense)")
    vocabulary = F.array(*[F.lit(t) for t in template_terms(templates)])
    found = rows.select(F.explode(F.array_intersect(terms(F.col("_text")), vocabulary)).alias("term"))
    counted = found.groupBy("term").agg(F.count(F.lit(1)).alias("df"))
    n_files = rows.count()
    weights = template_weights(counted, n_files, templates)
    n_terms = F.sum("tf").over(Window.partitionBy("template"))
    weights = checkpoint(weights.withColumn("width", F.ceil(n_terms / threshold ** 2)))

    light = Window.partitionBy("template").orderBy("w", "term")
    heavy = (weights.withColumn("upto", F.sqrt(F.sum(F.col("w") * F.col("w")).over(light)))
             .where(F.col("upto") >= F.col("tnorm") * threshold * 0.999).select("term").distinct())
    cues = F.array(*[F.lit(r["term"]) for r in heavy.collect()])  # terms of the templates
    widest = weights.agg(F.max("width")).first()[0] or 0
    # Texts that share an id and path stay apart.
    key = F.unhex(F.sha1(F.concat_ws("\0", F.col("_id").isNull().cast("string"),
                                     F.col("_id").cast("string"), "path", "_text")))
    keyed = rows.select("_id", "path", "_text", key.alias("_k"), named.alias("named"))
    lines = checkpoint(file_lines(keyed, cues, widest))
    idf = checkpoint(line_weights(lines, rows, n_files))
    matches = checkpoint(matching_windows(lines, weights, idf, n_files, threshold))
    # A window counts towards the file's share if none that it overlaps scores more.
    ranked = F.struct(F.col("score").alias("s"), (F.col("line") - F.col("last")).alias("short"), -F.col("line"))
    windows = matches.groupBy("_k", "line", "last").agg(F.max("score").alias("score")).withColumn("rank", ranked)
    over = (windows.withColumn("of", F.explode(F.sequence("line", "last")))
            .join(lines.select("_k", F.col("line").alias("of"), "n"), ["_k", "of"])
            .withColumn("top", F.max("rank").over(Window.partitionBy("_k", "of"))))
    share = (over.groupBy("_k", "line", "last").agg(F.sum("n").alias("n_terms"), F.bool_and(
        F.col("rank") == F.col("top")).alias("best")).where("best")
             .groupBy("_k").agg(F.sum("n_terms").alias("matched_terms")))
    best = matches.groupBy("_k").agg(F.min(F.struct((-F.col("score")).alias("s"), "line", "last", "license")).alias("best"))
    file_of = keyed.join(best.select("_k"), "_k", "left_semi").select("_k", "_id", "path").distinct()
    own = (best.join(share, "_k").join(file_of, "_k").groupBy("_id", "path")
           .agg(F.min("best").alias("best"), F.sum("matched_terms").alias("matched_terms")))
    own = checkpoint(own.select(F.col("_id").alias("_oid"), F.col("path").alias("_opath"),
                                (-F.col("best.s")).alias("own_score"), F.col("best.license").alias("own_license"),
                                F.col("best.line").alias("own_line"), "matched_terms"))
    every = rows.select("_id", "path", F.size(terms(F.col("_text"))).alias("all_terms"),
                        directory(F.col("path")).alias("dir"))
    every = every.join(own, every["_id"].eqNullSafe(own["_oid"]) & (every["path"] == own["_opath"]),
                       "left").drop("_oid", "_opath")
    every = checkpoint(every)
    licensed = (every.where(F.col("own_license").isNotNull()
                            & (named | (F.col("matched_terms") >= file_share * F.col("all_terms"))))
                .groupBy(F.col("dir").alias("from_dir"))
                .agg(F.min(F.struct((-F.col("own_score")).alias("s"), "path",
                                    "own_license")).alias("b"))
                .select("from_dir", F.col("b.own_license").alias("dir_license")))
    folders = every.where(F.col("own_license").isNull()).select("dir").distinct()
    nearest = (folders.withColumn("from_dir", F.explode(ancestors(F.col("dir"))))
               .join(licensed, "from_dir").groupBy("dir")
               .agg(F.max(F.struct(F.length("from_dir").alias("depth"), "from_dir", "dir_license")).alias("b"))
               .select("dir", F.col("b.from_dir").alias("inherited_from"),
                       F.col("b.dir_license").alias("dir_license")))
    return (every.join(nearest, "dir", "left")
            .select(F.col("_id").alias(id_col), "path", "own_license", "own_score", "own_line",
                    F.coalesce("own_license", "dir_license").alias("license"),
                    F.when(F.col("own_license").isNull(), F.col("inherited_from")).alias("inherited_from")))
