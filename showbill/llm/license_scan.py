"""Licence scans by sparse TF-IDF cosine, with inheritance from the nearest licence file (DataFrame operations only).

A text's statements are its lines' sentences and, since headers are wrapped, the sentences of its paragraphs with their
lines joined, both without comment marks. Statements with a licence word are weighed against
templates: terms by their frequency in the statement and their rarity among templates, and the cosine of the two
vectors. Only terms of the templates can add to the dot product, so statements meet templates in an equi-join on terms
with a table of fixed size; the other terms count in the statement's length. A tag that names a licence by its SPDX
identifier is a statement of score 1 for it. A file's licence is its best statement's
over a threshold. A licence file (by name, or because half of its words are licence statements) speaks for its
directory, one by name before others, and files without a licence of their own take that of the nearest ancestor directory that has one, found by
joining the distinct directories' ancestor paths with the directories of licence files. Texts are read once; what goes on is a
table of statements and of one short row per file.
"""

from __future__ import annotations

import math
from collections import Counter

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from showbill.llm.common import settle

# Fixed texts: statements by which files name their licence, or its leading sentences.
TEMPLATES = [
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0"),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance with the License"),
    ("Apache-2.0", "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an AS IS BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied"),
    ("Apache-2.0", "Apache License Version 2.0, January 2004 http://www.apache.org/licenses/ TERMS AND CONDITIONS FOR USE, REPRODUCTION, AND DISTRIBUTION"),
    ("MIT", "Released under the MIT License"),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files"),
    ("MIT", 'Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions'),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3"),
    ("GPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version"),
    ("GPL-3.0", "GNU GENERAL PUBLIC LICENSE Version 3, 29 June 2007"),
    ("GPL-2.0", "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version"),
    ("GPL-2.0", "either version 2 of the License, or (at your option) any later version"),
    ("GPL-2.0", "GNU GENERAL PUBLIC LICENSE Version 2, June 1991"),
    ("GPL-2.0", "Licensed under the GNU General Public License, version 2"),
    ("LGPL-3.0", "This library is free software licensed under the GNU Lesser General Public License, version 3"),
    ("LGPL-3.0", "This library is free software: you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version"),
    ("LGPL-2.1", "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation; either version 2.1 of the License, or (at your option) any later version"),
    ("LGPL-2.1", "either version 2.1 of the License, or (at your option) any later version"),
    ("AGPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version"),
    ("AGPL-3.0", "GNU AFFERO GENERAL PUBLIC LICENSE Version 3, 19 November 2007"),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"),
    ("BSD-3-Clause", "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission"),
    ("BSD-2-Clause", "Licensed under the BSD 2-Clause Simplified License"),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies"),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0"),
    ("MPL-2.0", "If a copy of the MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/"),
    ("EPL-2.0", "This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0 which is available at https://www.eclipse.org/legal/epl-2.0/"),
    ("Unlicense", "This is free and unencumbered software released into the public domain"),
    ("Zlib", "Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions"),
    ("BSL-1.0", "Distributed under the Boost Software License, Version 1.0"),
    ("WTFPL", "DO WHAT THE FUCK YOU WANT TO PUBLIC LICENSE"),
    ("CC-BY-4.0", "Licensed under CC BY 4.0"),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License"),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0"),
    ("CC-BY-SA-4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License"),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0"),
    ("CC-BY-NC-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License"),
    ("CC0-1.0", "To the extent possible under law, the author has dedicated this work to the public domain under CC0 1.0"),
    ("proprietary", "All rights reserved"),
]
HINT = r"licen[sc]e|copyright|permission|spdx|redistribut|public domain|creative commons|rights reserved|\bgnu\b|\bcc0?\b"
TERM = r"[a-z0-9](?:[a-z0-9.-]*[a-z0-9])?"
LICENCE_NAME = r"(?i)(^|/)(licen[sc]e|copying|notice)[^/]*$"
#: Comment marks at the beginning of a line, and at the end of one.
MARKS = r"(^|\n)[ \t]*(//+|#+|/?\*+/?|--+|;+|%+|<!--|\(\*|REM )[ \t]*"
TAG = r"spdx-license-identifier:[ \t]*\(?([a-z0-9.+-]+)"
#: Scores are kept to this many places.
PLACES = 6


def template_rows() -> tuple[list[tuple[str, str, float, float]], float]:
    """(template, term, weight of the term in the unit vector, rarity of the term) of all templates, and the rarity of any other term."""
    import re

    bags = [Counter(re.findall(TERM, t.lower())) for _, t in TEMPLATES]
    held = Counter(term for bag in bags for term in bag)
    rarity = {t: math.log((1 + len(bags)) / (1 + n)) + 1 for t, n in held.items()}
    rows = []
    for i, bag in enumerate(bags):
        length = math.sqrt(sum((n * rarity[t]) ** 2 for t, n in bag.items()))
        rows += [(i, t, n * rarity[t] / length, rarity[t]) for t, n in sorted(bag.items())]
    return rows, math.log(1 + len(bags)) + 1


def sentences(text: Column) -> Column:
    return F.split(F.regexp_replace(text, r"([.;])[ \t]+", "$1\n"), "\n")


def statements(text: Column) -> Column:
    """An array of structs: joined (0: sentence of a line, 1: of a paragraph whose lines are joined) and terms, for each statement with a licence word."""
    plain = F.regexp_replace(F.lower(text), MARKS, "$1")
    wrapped = F.regexp_replace(F.regexp_replace(plain, r"\n[ \t]*\n", "\u0001"), r"[ \t]*\n[ \t]*", " ")
    hinted = lambda cut, joined: F.transform(F.filter(cut, lambda s: s.rlike(HINT)), lambda s: F.struct(F.lit(joined).alias("joined"), F.regexp_extract_all(s, F.lit(f"({TERM})")).alias("terms")))
    lines = hinted(sentences(plain), 0)
    paragraphs = hinted(sentences(F.replace(wrapped, F.lit("\u0001"), F.lit("\n"))), 1)
    return F.when(text.rlike("(?i)" + HINT), F.concat(lines, paragraphs))


def tagged(text: Column) -> Column:
    """The licence of the first SPDX tag: a template's name, whatever its case and with or without -only and -or-later; else the tag as it stands; null without one."""
    tag = F.regexp_extract(text, "(?i)" + TAG, 1)
    plain = F.regexp_replace(F.lower(tag), r"(-only|-or-later|\+)$", "")
    known = {name.lower(): name for name, _ in TEMPLATES if name != "proprietary"}
    return F.when(tag != "", F.coalesce(F.element_at(F.create_map(*[F.lit(x) for kv in sorted(known.items()) for x in kv]), plain), tag))


def own_licenses(said: DataFrame, least: float) -> DataFrame:
    """row, license, score and licence_words (terms of matching statements, of lines or of paragraphs, whichever are more) of rows with a statement that scores at least `least`. said: row, at, joined and terms."""
    spark = said.sparkSession
    rows, other = template_rows()
    table = spark.createDataFrame(rows, "template int, term string, weight double, rarity double")
    rarity = table.select("term", "rarity").distinct()
    terms = said.select("row", "at", "joined", F.size("terms").alias("size"), F.explode("terms").alias("term")).groupBy("row", "at", "joined", "size", "term").agg(F.count("*").alias("n"))
    weighed = terms.join(F.broadcast(rarity), "term", "left").withColumn("tf_idf", F.col("n") * F.coalesce("rarity", F.lit(other)))
    length = weighed.groupBy("row", "at", "joined", "size").agg(F.sqrt(F.sum(F.col("tf_idf") * F.col("tf_idf"))).alias("length"))
    dots = weighed.join(F.broadcast(table.select("template", "term", "weight")), "term").groupBy("row", "at", "template").agg(F.sum(F.col("tf_idf") * F.col("weight")).alias("dot"))
    scored = dots.join(length, ["row", "at"]).withColumn("score", F.round(F.col("dot") / F.col("length"), PLACES)).where(F.col("score") >= least)
    best = scored.groupBy("row", "at", "joined", "size").agg(F.max(F.struct("score", (-F.col("template")).alias("t"))).alias("m"))
    names = F.array(*[F.lit(name) for name, _ in TEMPLATES])
    of = lambda joined: F.sum(F.when(F.col("joined") == joined, F.col("size")).otherwise(0))
    return best.groupBy("row").agg(F.max(F.struct("m.score", "m.t")).alias("m"), F.greatest(of(0), of(1)).alias("licence_words")).select(
        "row", F.element_at(names, 1 - F.col("m.t")).alias("license"), F.col("m.score").alias("score"), "licence_words"
    )


def directory(path: Column | str) -> Column:
    """The path without its last part; the empty string for files at the top."""
    return F.regexp_replace(path, r"/?[^/]*$", "")


def scan(docs: DataFrame, least: float = 0.6, share: float = 0.5) -> DataFrame:
    """license, score and found ("own", "inherited" or "none") of each row of docs (path, text), with its other columns but text.

    Files with a null text have no licence of their own. A null path is read as the empty one. Rows that repeat a path
    are files of their own in its directory. Columns of docs named like an added one are replaced. An empty table gives
    an empty result.
    """
    added = {"license", "score", "found", "text"}
    more = [c for c in docs.columns if c.lower() not in added and c != "path"]
    text = F.col("text")
    count = F.size(F.regexp_extract_all(F.lower(F.coalesce(text, F.lit(""))), F.lit(f"({TERM})"))).cast("long")
    files = settle(docs.select(
        F.coalesce("path", F.lit("")).alias("path"), F.struct(*[F.col(f"`{c}`") for c in more], F.lit(0)).alias("more"),
        count.alias("words"), statements(text).alias("said"), tagged(text).alias("tag"), F.monotonically_increasing_id().alias("row"),
    ))
    said = files.select("row", F.posexplode("said").alias("at", "s")).select("row", "at", "s.joined", "s.terms")
    own = settle(own_licenses(said, least))
    named = F.col("path").rlike(LICENCE_NAME)
    known = settle(files.drop("said").join(own, "row", "left").select(
        "row", "path", "more", "words", F.coalesce("tag", "license").alias("license"), F.when(F.col("tag").isNotNull(), 1.0).otherwise(F.col("score")).alias("score"), "licence_words",
    ))
    speaks = known.where(F.col("license").isNotNull() & (named | (F.col("licence_words") >= share * F.col("words"))))
    of_dir = settle(speaks.groupBy(directory("path").alias("dir")).agg(F.max(F.struct(named.alias("named"), "score", "license")).alias("m")).select("dir", F.col("m.license").alias("inherited")))
    # The ancestors of a directory are the prefixes of its parts, itself and the top included.
    parts = F.split("home", "/")
    ancestors = F.transform(F.sequence(F.lit(0), F.size(parts)), lambda i: F.struct(i.alias("depth"), F.array_join(F.slice(parts, 1, i), "/").alias("dir")))
    homes = known.select(directory("path").alias("home")).distinct()
    near = homes.select("home", F.explode(ancestors).alias("a")).select("home", "a.depth", "a.dir").join(of_dir, "dir")
    nearest = settle(near.groupBy("home").agg(F.max_by("inherited", "depth").alias("inherited")))
    joined = known.withColumn("home", directory("path")).join(nearest, "home", "left")
    return joined.select(
        "path",
        *[F.col("more").getField(c).alias(c) for c in more],
        F.coalesce("license", "inherited").alias("license"),
        "score",
        F.when(F.col("license").isNotNull(), "own").when(F.col("inherited").isNotNull(), "inherited").otherwise("none").alias("found"),
    )


def report(docs: DataFrame) -> DataFrame:
    """doc_id, license, score and found of each row of docs, whose path is source/lang/doc_id; a slash in a name is written %2F."""
    part = lambda c: F.replace(F.coalesce(F.col(c).cast("string"), F.lit("-")), F.lit("/"), F.lit("%2F"))
    paths = docs.select(F.concat_ws("/", part("source"), part("lang"), part("doc_id")).alias("path"), "doc_id", "text")
    return scan(paths).select("doc_id", "license", "score", "found")


def _oracle() -> str:
    rows, other = template_rows()
    values = ", ".join(f"({i}, '{t}', {w!r}::DOUBLE, {r!r}::DOUBLE)" for i, t, w, r in rows)
    names = ", ".join(f"({i}, '{n}')" for i, (n, _) in enumerate(TEMPLATES))
    known = ", ".join(f"('{n}')" for n in sorted({n for n, _ in TEMPLATES if n != "proprietary"}))
    part = lambda c: f"replace(coalesce(CAST({c} AS VARCHAR), '-'), '/', '%2F')"
    return rf"""
WITH tpl(template, term, weight, rarity) AS (VALUES {values}),
names(template, name) AS (VALUES {names}),
ids(name) AS (VALUES {known}),
files AS (SELECT row_number() OVER () AS rid, {part("source")} || '/' || {part("lang")} AS home, doc_id, coalesce(text, '') AS text FROM documents),
plain AS (SELECT rid, regexp_replace(lower(text), '{MARKS}', '\1', 'g') AS text FROM files),
texts AS (
  SELECT rid, 0 AS joined, text FROM plain UNION ALL
  SELECT rid, 1, replace(regexp_replace(regexp_replace(text, '\n[ \t]*\n', chr(1), 'g'), '[ \t]*\n[ \t]*', ' ', 'g'), chr(1), chr(10)) FROM plain),
cut AS (SELECT rid, joined, unnest(string_split(regexp_replace(text, '([.;])[ \t]+', '\1' || chr(10), 'g'), chr(10))) AS said, generate_subscripts(string_split(regexp_replace(text, '([.;])[ \t]+', '\1' || chr(10), 'g'), chr(10)), 1) AS pos FROM texts),
hinted AS (SELECT rid, joined, pos, regexp_extract_all(said, '{TERM}') AS terms FROM cut WHERE regexp_matches(said, '{HINT}')),
bag AS (SELECT rid, joined, pos, size, term, count(*) AS n FROM (SELECT rid, joined, pos, len(terms) AS size, unnest(terms) AS term FROM hinted) GROUP BY ALL),
weighed AS (SELECT bag.*, n * coalesce(rarity, {other!r}::DOUBLE) AS tf_idf FROM bag LEFT JOIN (SELECT DISTINCT term, rarity FROM tpl) USING (term)),
lens AS (SELECT rid, joined, pos, size, sqrt(sum(tf_idf * tf_idf)) AS length FROM weighed GROUP BY ALL),
dots AS (SELECT rid, joined, pos, template, sum(tf_idf * weight) AS dot FROM weighed JOIN tpl USING (term) GROUP BY ALL),
scored AS (SELECT rid, joined, pos, size, template, round(dot / length, {PLACES}) AS score FROM dots JOIN lens USING (rid, joined, pos) WHERE round(dot / length, {PLACES}) >= 0.6),
per AS (SELECT rid, joined, pos, size, max(score) AS score FROM scored GROUP BY ALL),
words_in AS (SELECT rid, max(n) AS licence_words FROM (SELECT rid, joined, sum(size) AS n FROM per GROUP BY ALL) GROUP BY rid),
top AS (SELECT rid, template, score FROM scored QUALIFY row_number() OVER (PARTITION BY rid ORDER BY score DESC, template) = 1),
own AS (SELECT rid, name AS license, score, licence_words FROM top JOIN names USING (template) JOIN words_in USING (rid)),
tags AS (SELECT rid, regexp_extract(text, '(?i){TAG}', 1) AS tag FROM files),
tagged AS (SELECT rid, coalesce(name, tag) AS tag FROM tags LEFT JOIN ids ON lower(name) = regexp_replace(lower(tag), '(-only|-or-later|\+)$', '') WHERE tag <> ''),
known AS (SELECT home, rid, doc_id, coalesce(tag, license) AS license, CASE WHEN tag IS NOT NULL THEN 1.0::DOUBLE ELSE score END AS score, licence_words, len(regexp_extract_all(lower(text), '{TERM}')) AS words FROM files LEFT JOIN own USING (rid) LEFT JOIN tagged USING (rid)),
speaks AS (SELECT home, license FROM known WHERE license IS NOT NULL AND licence_words >= 0.5 * words QUALIFY row_number() OVER (PARTITION BY home ORDER BY score DESC, license DESC) = 1)
SELECT doc_id, coalesce(k.license, s.license) AS license, score,
  CASE WHEN k.license IS NOT NULL THEN 'own' WHEN s.license IS NOT NULL THEN 'inherited' ELSE 'none' END AS found
FROM known k LEFT JOIN speaks s USING (home)
"""


ORACLE = _oracle()
