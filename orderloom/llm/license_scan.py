"""Licence scans: TF-IDF cosine of headers and licence files to templates, then inheritance along directories."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from orderloom.operators.joins import join_per_key

from .common import let, n_words_of, staged, text_of

_GNU = "This {0} is free software: you can redistribute it and/or modify it under the terms of the GNU {1}General Public License as published by the Free Software Foundation, either version {2} of the License, or (at your option) any later version."
_CC = "This work is licensed under a Creative Commons {} 4.0 International License."


def _gnu(kind: str, version: str, date: str, *names: str) -> list[str]:
    full, year = f"GNU {kind}General Public License", date.split()[-1]
    return [
        f"This work is licensed under the {full}, version {version}.", f"{full} Version {version}", f"{full} Version {version}, {date}",
        f"{full} Version {version}, {date} Copyright (C) {year} Free Software Foundation, Inc. Everyone is permitted to copy and distribute verbatim copies of this license document",
        *[_GNU.format(what, kind, version) for what in ("program", "file", "library")], *[f"SPDX-License-Identifier: {n}" for n in names],
    ]


#: By which notices, titles and identifiers works state their licence.
TEMPLATES = {
    "AGPL-3.0": _gnu("Affero ", "3", "19 November 2007", "AGPL-3.0", "AGPL-3.0-only", "AGPL-3.0-or-later"),
    "Apache-2.0": [
        "Licensed under the Apache License, Version 2.0.", "Apache License Version 2.0, January 2004 http://www.apache.org/licenses/",
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
        "SPDX-License-Identifier: Apache-2.0",
    ],
    "BSD-2-Clause": ["BSD 2-Clause License", "Redistribution and use in source and binary forms are permitted under the BSD 2-Clause License.", "SPDX-License-Identifier: BSD-2-Clause"],
    "BSD-3-Clause": [
        "Redistribution and use in source and binary forms, with or without modification, are permitted under the BSD 3-Clause License.", "BSD 3-Clause License",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:",
        "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file.", "SPDX-License-Identifier: BSD-3-Clause",
    ],
    "CC-BY-4.0": ["Licensed under CC BY 4.0.", _CC.format("Attribution"), "SPDX-License-Identifier: CC-BY-4.0"],
    "CC-BY-NC-4.0": ["Licensed under CC BY-NC 4.0.", _CC.format("Attribution-NonCommercial"), "SPDX-License-Identifier: CC-BY-NC-4.0"],
    "CC-BY-SA-4.0": ["Licensed under CC BY-SA 4.0.", _CC.format("Attribution-ShareAlike"), "SPDX-License-Identifier: CC-BY-SA-4.0"],
    "CC0-1.0": ["To the extent possible under law, the author has waived all copyright to this work under CC0 1.0.", "CC0 1.0 Universal", "SPDX-License-Identifier: CC0-1.0"],
    "GPL-2.0": _gnu("", "2", "June 1991", "GPL-2.0", "GPL-2.0-only", "GPL-2.0-or-later", "GPL-2.0+"),
    "GPL-3.0": _gnu("", "3", "29 June 2007", "GPL-3.0", "GPL-3.0-only", "GPL-3.0-or-later", "GPL-3.0+"),
    "ISC": ["ISC License", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.", "SPDX-License-Identifier: ISC"],
    "LGPL-2.1": _gnu("Lesser ", "2.1", "February 1999", "LGPL-2.1", "LGPL-2.1-only", "LGPL-2.1-or-later"),
    "LGPL-3.0": _gnu("Lesser ", "3", "29 June 2007", "LGPL-3.0", "LGPL-3.0-only", "LGPL-3.0-or-later"),
    "MIT": [
        "Released under the MIT License.", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software.", "The MIT License (MIT)",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software",
        "SPDX-License-Identifier: MIT",
    ],
    "MPL-2.0": [
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.", "Mozilla Public License Version 2.0",
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/.",
        "SPDX-License-Identifier: MPL-2.0",
    ],
    "Unlicense": ["This is free and unencumbered software released into the public domain.", "SPDX-License-Identifier: Unlicense"],
}
NOTICE = "(?i)licen[cs]|copyright|permission|redistribut|waived|public domain|cc[ -]by"  # a header has a line with one of these
LICENSE_FILE = "(?i)(^|/)(licen[cs]e|copying|notice)[^/]*$"
MIN_COSINE = 0.6
MIN_SHARE = 0.5  # a file is a licence file too if so large a share of its words stands in lines that read like notices

COMMENT = r"^[\x20\x09-\x0D]*(?:/\*+|\*+/|\*+|//+|#+|;+|%+|--+|<!--)?[\x20\x09-\x0D]*|[\x20\x09-\x0D]*(?:\*+/|-->)?[\x20\x09-\x0D]*$"  # comment marks at a line's ends
SPDX = "spdx-license-identifier:"


def _terms(text: Column) -> Column:
    """Runs of letters and digits; what an SPDX line names are terms of their own, which only the same identifier has."""
    lower = F.lower(text)
    named = F.filter(F.split(F.substring_index(lower, SPDX, -1), "[^a-z0-9.+-]+", -1), lambda x: ~x.isin("", "or", "and", "with"))
    words = F.regexp_extract_all(lower, F.lit("[a-z0-9]+"), F.lit(0))
    return F.when(lower.contains(SPDX), F.transform(named, lambda x: F.concat(F.lit("spdx:"), x))).otherwise(words)


def headers_of(text: Column) -> Column:
    """The units of a text that are compared: every line that reads like a notice, and runs of such lines with the line
    before or after where the sentence goes on from or into it.

    Comment marks are left out and the lines of a run are joined, so that a notice may be wrapped. SPDX lines stand alone.
    """
    def units(lines: Column) -> Column:
        marked = F.transform(lines, lambda x: x.rlike(NOTICE) & ~F.lower(x).contains(SPDX))
        goes_on = F.transform(lines, lambda x: (x != "") & ~x.rlike("[.!?:]$"))
        at = lambda flags, i: F.coalesce(F.get(flags, i), F.lit(False))

        def beside(i: Column) -> Column:
            return at(marked, i) | at(marked, i - 1) & at(goes_on, i - 1) | at(marked, i + 1) & at(goes_on, i)

        joined = F.array_join(F.transform(lines, lambda x, i: F.when(beside(i) & ~F.lower(x).contains(SPDX), F.concat(x, F.lit(" "))).otherwise(F.lit("\n"))), "")
        runs = F.filter(F.transform(F.split(joined, "\n+", -1), lambda r: F.trim(F.regexp_replace(r, " +", " "))), lambda r: r != "")
        return F.array_distinct(F.concat(F.filter(lines, lambda x: x.rlike(NOTICE)), runs))

    lines = F.transform(F.split(text, "\n", -1), lambda x: F.regexp_replace(x, COMMENT, ""))
    return F.when(text.rlike(NOTICE), let(lines, units)).otherwise(F.array().cast("array<string>"))


def closest_templates(units: DataFrame, templates: dict[str, list[str]]) -> DataFrame:
    """``unit``, ``license``, ``score``: the template with the largest cosine, for every distinct ``unit`` that shares a term with one.

    Weights are term counts times ln((1 + n) / (1 + units with the term)) + 1 over all units. Vectors are rows
    (unit, term, weight); templates, a fixed small table, are joined by term.
    """
    spark = units.sparkSession
    counted = staged(
        units.select("unit", F.explode(_terms(F.col("unit"))).alias("term")).groupBy("unit", "term").agg(F.count(F.lit(1)).alias("n")), "licence-terms"
    )
    total = units.count()
    idf = lambda df: F.log((1.0 + total) / (1.0 + df)) + 1.0
    spread = staged(counted.groupBy("term").agg(F.count(F.lit(1)).alias("units")), "licence-spread")
    given = spark.createDataFrame([(name, k, t) for name, ts in templates.items() for k, t in enumerate(ts)], "license string, variant int, notice string")
    known = given.select("license", "variant", F.explode(_terms(F.col("notice"))).alias("term")).groupBy("license", "variant", "term").agg(F.count(F.lit(1)).alias("n"))
    weighed = known.join(spread, "term", "left").select("license", "variant", "term", (F.col("n") * idf(F.coalesce("units", F.lit(0)))).alias("w"))
    norm = Window.partitionBy("license", "variant")
    weighed = staged(weighed.select("*", F.sqrt(F.sum(F.col("w") ** 2).over(norm)).alias("norm")), "licence-templates")
    vectors = join_per_key(counted, spread, "term").select("unit", "term", (F.col("n") * idf(F.col("units"))).alias("v"))
    lengths = vectors.groupBy("unit").agg(F.sqrt(F.sum(F.col("v") ** 2)).alias("length"))
    dots = (
        vectors.join(weighed, "term").groupBy("unit", "license", "variant")
        .agg((F.sum(F.col("v") * F.col("w")) / F.first("norm")).alias("dot"))
    )
    cosine = dots.join(lengths, "unit").select("unit", "license", F.round(F.col("dot") / F.col("length"), 6).alias("score"))
    return cosine.groupBy("unit").agg(F.max_by(F.struct("license", "score"), F.struct("score", "license")).alias("best")).select("unit", "best.*")


def parents(path: Column) -> Column:
    """The directories above a path, nearest first; the root is the empty path."""
    steps = F.slice(F.split(path, "/"), F.lit(1), F.size(F.split(path, "/")) - 1)
    depth = F.size(F.split(path, "/")) - 1
    up = F.transform(F.sequence(depth, F.lit(0), F.lit(-1)), lambda d: F.array_join(F.slice(steps, F.lit(1), d), "/"))
    return F.when(path.isNotNull(), up)


def scan(docs: DataFrame, path_column: str = "path", id_column: str = "doc_id", templates: dict[str, list[str]] = TEMPLATES) -> DataFrame:
    """One row per document: the id, ``path``, ``license``, ``score``, ``origin`` (header, file, inherited or null) and ``from_directory``.

    A document's headers, see ``headers_of``, and the whole text of files with a licence's
    name are compared with the templates; the best match of at least MIN_COSINE is its licence. Licence files,
    by name or because mostly notices, hand theirs to all files without one in and below
    their directory; the nearest directory decides, in it the best score, then the licence's name.
    Equal headers are compared once, however many documents have them.

    Defined cases: null and empty texts have no header but can inherit; a null path inherits nothing; lines of any length count
    whole; repeated rows get a row each; an empty table gives no rows; other columns are not looked at.
    """
    path = F.col(path_column).cast("string")
    rows = docs.select(
        F.struct(F.col(id_column).alias("id"), path.alias("path"), F.xxhash64("text"), F.octet_length(F.col("text").cast("string"))).alias("row_key"),
        F.col(id_column).alias("id"), path.alias("path"), F.coalesce(path.rlike(LICENSE_FILE), F.lit(False)).alias("named"), text_of().alias("text"),
    )
    headers = headers_of(F.col("text"))
    units = F.array_distinct(F.when(F.col("named"), F.concat(headers, F.array("text"))).otherwise(headers))
    notices = F.filter(F.split("text", "\n", -1), lambda x: x.rlike(NOTICE))
    share = n_words_of(F.array_join(notices, " ")) / F.greatest(n_words_of(F.col("text")), F.lit(1))
    listed = staged(
        rows.where(F.col("named") | F.col("text").rlike(NOTICE)).select("row_key", "path", (F.col("named") | (share >= MIN_SHARE)).alias("is_file"), units.alias("units")),
        "licence-headers",
    )
    seen = listed.select("row_key", "path", "is_file", F.explode("units").alias("unit"))
    best = staged(closest_templates(staged(seen.select("unit").distinct(), "licence-units"), templates).where(F.col("score") >= MIN_COSINE), "licence-matches")
    own = staged(
        join_per_key(seen, best, "unit").groupBy("row_key")
        .agg(F.max_by(F.struct("license", "score"), F.struct("score", "license")).alias("best"), F.first("path").alias("path"), F.first("is_file").alias("is_file"))
        .select("row_key", "path", "is_file", "best.license", "best.score"),
        "licence-owners",
    )
    directories = staged(
        own.where("is_file AND path IS NOT NULL").select(F.get(parents(F.col("path")), F.lit(0)).alias("directory"), "license", "score")
        .groupBy("directory").agg(F.max_by(F.struct("license", "score"), F.struct("score", "license")).alias("held")),
        "licence-directories",
    )
    without = rows.select("path").where("path IS NOT NULL").select(F.get(parents(F.col("path")), F.lit(0)).alias("directory")).distinct()
    above = without.select("directory", F.explode(F.concat(F.array("directory"), parents(F.col("directory")))).alias("up")).where("up <> directory OR directory = ''")
    above = above.unionByName(without.select("directory", F.col("directory").alias("up"))).distinct()
    nearest = staged(
        above.join(directories, above["up"] == directories["directory"]).groupBy(above["directory"].alias("directory"))
        .agg(F.max_by(F.struct("up", "held"), F.length("up")).alias("n")).select("directory", "n.up", "n.held.license", "n.held.score"),
        "licence-nearest",
    )
    kept = own.select("row_key", F.col("license").alias("own_license"), F.col("score").alias("own_score"), "is_file").alias("o")
    near = nearest.alias("n")
    every = rows.select("row_key", "id", "path", F.get(parents(F.col("path")), F.lit(0)).alias("directory")).alias("r")
    joined = every.join(kept, F.col("r.row_key").eqNullSafe(F.col("o.row_key")), "left").join(near, F.col("r.directory") == F.col("n.directory"), "left")
    mine = F.col("own_license").isNotNull()
    return joined.select(
        F.col("r.id").alias(id_column), F.col("r.path").alias("path"),
        F.coalesce("own_license", "n.license").alias("license"), F.when(mine, F.col("own_score")).otherwise(F.col("n.score")).alias("score"),
        F.when(mine & F.col("is_file"), "file").when(mine, "header").when(F.col("n.license").isNotNull(), "inherited").alias("origin"),
        F.when(~mine | mine.isNull(), F.col("n.up")).alias("from_directory"),
    )
