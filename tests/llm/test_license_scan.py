"""Matches against plain TF-IDF, inheritance against a walk up the path, and defined edge cases."""

import math
import re
from collections import Counter

from orderloom.llm import license_scan as lic


def terms(text):
    text = text.lower()
    if "spdx-license-identifier:" in text:
        named = re.split("[^a-z0-9.+-]+", text.rpartition("spdx-license-identifier:")[2])
        return ["spdx:" + x for x in named if x not in ("", "or", "and", "with")]
    return re.findall(r"[a-z0-9]+", text)


def headers(text):
    """Notice lines, and runs of them with the neighbours that their sentences share; SPDX lines end runs."""
    if not re.search(lic.NOTICE, text):
        return []
    lines = [re.sub(lic.COMMENT, "", x) for x in text.split("\n")]
    spdx = ["spdx-license-identifier:" in x.lower() for x in lines]
    marked = [bool(re.search(lic.NOTICE, x)) and not y for x, y in zip(lines, spdx, strict=True)]
    goes_on = [x != "" and x[-1] not in ".!?:" for x in lines]

    def inside(i):
        before = i > 0 and marked[i - 1] and goes_on[i - 1]
        return marked[i] or before or (i + 1 < len(lines) and marked[i + 1] and goes_on[i])

    runs, run = [], []
    for i, x in enumerate(lines):
        if not spdx[i] and inside(i):
            run.append(x)
        else:
            runs, run = [*runs, run], []
    runs = [re.sub(" +", " ", " ".join(r)).strip(" ") for r in [*runs, run]]
    return sorted({*[x for x in lines if re.search(lic.NOTICE, x)], *[r for r in runs if r]})


def plain_best(units):
    df = Counter(t for u in units for t in set(terms(u)))
    idf = lambda t: math.log((1 + len(units)) / (1 + df[t])) + 1
    vector = lambda text: {t: n * idf(t) for t, n in Counter(terms(text)).items()}
    norm = lambda v: math.sqrt(sum(x * x for x in v.values()))
    out = {}
    for u in units:
        v = vector(u)
        scores = []
        for name, notices in lic.TEMPLATES.items():
            for notice in notices:
                w = vector(notice)
                dot = sum(v[t] * w[t] for t in v if t in w)
                if dot:
                    scores.append((round(dot / norm(v) / norm(w), 6), name))
        if scores:
            out[u] = max(scores)
    return out


def plain(rows):
    read = []
    for doc, path, text in rows:
        text = text or ""
        notices = [x for x in text.split("\n") if re.search(lic.NOTICE, x)]
        named = path is not None and re.search(lic.LICENSE_FILE, path) is not None
        words = lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t))
        is_file = named or (bool(notices) and words(" ".join(notices)) / max(words(text), 1) >= lic.MIN_SHARE)
        read.append((doc, path, is_file, headers(text) + ([text] if named else [])))
    best = plain_best(sorted({u for *_, units in read for u in units}))
    held, own = {}, []
    for _, path, is_file, units in read:
        match = max((best[u] for u in units if u in best and best[u][0] >= lic.MIN_COSINE), default=None)
        own.append(match)
        if match and is_file and path is not None:
            folder = path.rpartition("/")[0]
            held[folder] = max(held.get(folder, (0, "")), match)
    out = []
    for (doc, path, is_file, _), match in zip(read, own, strict=True):
        if match:
            out.append((doc, path, match[1], match[0], "file" if is_file else "header", None))
            continue
        folder, hit = path.rpartition("/")[0] if path is not None else None, None
        while folder is not None:
            if folder in held:
                hit = folder
                break
            folder = folder.rpartition("/")[0] if folder else None
        out.append((doc, path, *((held[hit][1], held[hit][0], "inherited", hit) if hit is not None else (None,) * 4)))
    return sorted(out, key=str)


def check(spark, rows):
    df = spark.createDataFrame([(*r, 1, "x") for r in rows], "doc_id long, path string, text string, score int, unit string")
    got = lic.scan(df).collect()
    mine = sorted((tuple(r) for r in got), key=str)
    want = plain(rows)
    assert [(*r[:3], *r[4:]) for r in mine] == [(*r[:3], *r[4:]) for r in want]
    assert all(abs((a[3] or 0) - (b[3] or 0)) < 1e-5 for a, b in zip(mine, want, strict=True))
    return mine


def test_headers_files_and_inheritance(spark):
    mit, gpl = lic.TEMPLATES["MIT"][0], lic.TEMPLATES["GPL-3.0"][0]
    body = "code " * 40
    rows = [
        (1, "a/LICENSE", f"{mit}\n{lic.TEMPLATES['MIT'][1]}"), (2, "a/x.py", body), (3, "a/b/c/y.py", body), (4, "a/b/COPYING", gpl),
        (5, "a/z.py", f"# {gpl.lower()}\n{body}"), (6, "q/x.py", body), (7, "x.py", body), (8, "LICENSE.txt", lic.TEMPLATES["MPL-2.0"][0]),
        (9, None, mit), (10, None, body), (11, None, None), (12, "a/", ""), (13, "/abs/x", body), (14, "a/b/short", f"{mit} ok"),
        (15, "t/copyright.py", "copyright is a word in this line of prose about nothing"), (2, "a/x.py", body), (None, "a/n", None),
        (16, "deep/" * 50 + "f", body), (17, "long", body + "\n" + "licence " * 20_000),
    ]
    got = check(spark, rows)
    assert {r[0]: r[2] for r in got if r[0] in (2, 3, 5, 6)} == {2: "MIT", 3: "GPL-3.0", 5: "GPL-3.0", 6: "MPL-2.0"}


NOTICES = [
    ("# SPDX-License-Identifier: Apache-2.0", "Apache-2.0"),
    ("// SPDX-License-Identifier: MIT", "MIT"),
    ("/* SPDX-License-Identifier: GPL-2.0-or-later */", "GPL-2.0"),
    ("# SPDX-License-Identifier: BSD-2-Clause", "BSD-2-Clause"),
    ("# SPDX-License-Identifier: Zlib", None),
    ("/*\n * Licensed under the Apache License, Version 2.0 (the \"License\");\n * you may not use this file except in compliance with the License.\n * You may obtain a copy of the License at\n *\n *     http://www.apache.org/licenses/LICENSE-2.0\n */", "Apache-2.0"),
    ("# This program is free software: you can redistribute it and/or modify\n# it under the terms of the GNU General Public License as published by\n# the Free Software Foundation, either version 3 of the License, or\n# (at your option) any later version.", "GPL-3.0"),
    ("// This program is free software; you can redistribute it and/or modify\n// it under the terms of the GNU General Public License as published by\n// the Free Software Foundation; either version 2 of the License, or\n// (at your option) any later version.", "GPL-2.0"),
    (" * This library is free software; you can redistribute it and/or\n * modify it under the terms of the GNU Lesser General Public\n * License as published by the Free Software Foundation; either\n * version 2.1 of the License, or (at your option) any later version.", "LGPL-2.1"),
    ("                    GNU GENERAL PUBLIC LICENSE\n                       Version 3, 29 June 2007\n\n Copyright (C) 2007 Free Software Foundation, Inc. <https://fsf.org/>\n Everyone is permitted to copy and distribute verbatim copies\n of this license document, but changing it is not allowed.\n\n" + "terms and conditions of all kinds\n" * 60, "GPL-3.0"),
    ("GNU GENERAL PUBLIC LICENSE\nVersion 2", "GPL-2.0"),
    ("// Use of this source code is governed by a BSD-style\n// license that can be found in the LICENSE file.", "BSD-3-Clause"),
    ("The MIT License (MIT)\n\nCopyright (c) 2024 Someone\n\nPermission is hereby granted, free of charge, to any person obtaining a copy\nof this software and associated documentation files (the \"Software\"), to deal\nin the Software without restriction", "MIT"),
    ("<!-- This Source Code Form is subject to the terms of the Mozilla Public\n   - License, v. 2.0. -->", "MPL-2.0"),
    ("We talked about a driving licence for an hour.", None),
    ("Copyright of the photographs remains with the people in them", None),
]


def test_usual_notices(spark):
    """Each above code that says nothing of licences, beside many others."""
    body = "\n\n" + "def f(x):\n    return x + 1\n" * 30
    got = check(spark, [(k, f"d{k}/x.py", text + body) for k, (text, _) in enumerate(NOTICES)])
    assert [r[2] for r in sorted(got)] == [name for _, name in NOTICES]
    got = check(spark, [(k, f"d{k}/LICENSE", text) for k, (text, _) in enumerate(NOTICES)])
    assert [r[2] for r in sorted(got)] == [name for _, name in NOTICES]


def test_documents_and_empty_table(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").collect()
    got = check(spark, [(r["doc_id"], f"{r['source']}/{r['lang']}/{r['doc_id']}", r["text"]) for r in docs])
    assert any(r[4] == "header" for r in got)
    check(spark, [])
