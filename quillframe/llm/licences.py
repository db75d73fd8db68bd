"""Licence scans: headers and licence files against templates, then directories.

Every line, every paragraph, the leading comment and the whole of every text
are compared with lines, paragraphs and full texts of known licences by the
cosine of their TF-IDF vectors. A file's licence is that of its best part. A
file whose whole text is near enough to a template, or of which licence lines
are a large share, is a licence file, and gives its licence to its directory;
files without a licence of their own take that of the nearest directory above
them that has one.

Everything is DataFrame operations. Equal parts are compared once however many
files share them, and directories inherit before files do, so neither a
widespread line nor a crowded directory gathers in one task.
"""

from __future__ import annotations

import math
import re
from importlib.resources import files as packaged

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ._common import constant_table, written

THRESHOLD = 0.8
FILE_SHARE = 0.5

# Lines by which licences are stated, (SPDX identifier, line).
TEMPLATES = (
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("MIT", "SPDX-License-Identifier: MIT"),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files"),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "SPDX-License-Identifier: Apache-2.0"),
    ("Apache-2.0", "Apache License, Version 2.0, January 2004"),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "SPDX-License-Identifier: GPL-3.0-only"),
    ("GPL-3.0", "GNU General Public License, Version 3, 29 June 2007"),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("GPL-2.0", "SPDX-License-Identifier: GPL-2.0-only"),
    ("LGPL-3.0", "This work is licensed under the GNU Lesser General Public License, version 3."),
    ("AGPL-3.0", "This work is licensed under the GNU Affero General Public License, version 3."),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"),
    ("BSD-3-Clause", "SPDX-License-Identifier: BSD-3-Clause"),
    ("BSD-3-Clause", "Licensed under the BSD 3-Clause License."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted"),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-ND-4.0", "Licensed under CC BY-ND 4.0."),
    ("CC-BY-NC-SA-4.0", "Licensed under CC BY-NC-SA 4.0."),
    ("CC0-1.0", "To the extent possible under law, the author has waived all copyright and related rights to this work under CC0 1.0."),
    ("Proprietary", "Copyright. All rights reserved."),
)

_NOTICE = (
    "This program is free software: you can redistribute it and/or modify it under the terms of the GNU {0} General Public License as published by the Free Software Foundation, either version {1} of the License, or (at your option) any later version.",
    "This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU {0} General Public License for more details.",
    "You should have received a copy of the GNU {0} General Public License along with this program. If not, see <https://www.gnu.org/licenses/>.",
)
_GNU = (("GPL-3.0", "", "3"), ("GPL-2.0", "", "2"), ("LGPL-3.0", "Lesser", "3"), ("LGPL-2.1", "Lesser", "2.1"), ("AGPL-3.0", "Affero", "3"))
_APACHE = (
    "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
    "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an AS IS BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License.",
)
_FULL = ("MIT", "BSD-3-Clause", "BSD-2-Clause", "ISC", "Apache-2.0", "GPL-3.0", "GPL-2.0", "LGPL-3.0", "LGPL-2.1", "MPL-2.0", "CC0-1.0")


def _full(name: str) -> str:
    return (packaged(__package__) / "licence_texts" / f"{name}.txt").read_text(encoding="utf-8")


def _first_paragraph(name: str) -> str:
    return _full(name).split("\n\n")[0]


# Titles, notices in file headers, opening paragraphs and full texts.
BLOCKS = (
    ("MIT", "MIT License"), ("MIT", "The MIT License (MIT)"), ("ISC", "ISC License"), ("BSD-3-Clause", "BSD 3-Clause License"), ("BSD-2-Clause", "BSD 2-Clause License"),
    ("GPL-2.0", "GNU General Public License, Version 2, June 1991"), ("LGPL-2.1", "GNU Lesser General Public License, Version 2.1, February 1999"),
    ("LGPL-3.0", "GNU Lesser General Public License, Version 3, 29 June 2007"), ("LGPL-3.0", "GNU Lesser General Public License"),
    ("AGPL-3.0", "GNU Affero General Public License, Version 3, 19 November 2007"), ("AGPL-3.0", "GNU Affero General Public License"),
    *((name, _NOTICE[0].format(kind, version)) for name, kind, version in _GNU),
    *((name, " ".join(_NOTICE[:2]).format(kind, version)) for name, kind, version in _GNU),
    *((name, " ".join(_NOTICE).format(kind, version)) for name, kind, version in _GNU),
    ("Apache-2.0", _APACHE[0]), ("Apache-2.0", " ".join(_APACHE)),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/."),
    *((name, _first_paragraph(name)) for name in ("MIT", "ISC")),
    *((name, _full(name)) for name in _FULL),
)

TERM = "[a-z0-9]+"


def terms(text: Column) -> Column:
    """The terms of a text: runs of ASCII letters and digits, in lower case."""
    return F.regexp_extract_all(F.lower(text), F.lit(f"({TERM})"), F.lit(1))


def idf(df: DataFrame, text_col: str, vocabulary: list[str]) -> tuple[dict[str, float], float]:
    """Inverse document frequencies of a fixed vocabulary over all rows, and that of a term outside it (as if in one document)."""
    spark = df.sparkSession
    words = constant_table(spark, [(w,) for w in vocabulary], "term: string")
    rows = df.select(F.explode(F.array_distinct(terms(F.col(text_col)))).alias("term")).join(F.broadcast(words), "term")
    counts = {r["term"]: r["n"] for r in rows.groupBy("term").agg(F.count(F.lit(1)).alias("n")).collect()}
    n = df.count()
    weight = lambda d: math.log((1 + n) / (1 + d)) + 1
    return {w: weight(counts.get(w, 0)) for w in vocabulary}, weight(min(n, 1))


def anchors(vectors: list[dict[str, float]], threshold: float, weights: dict[str, float] | None = None) -> set[str]:
    """Terms of which a text must have one to reach the threshold with a template.

    A text with none but the other terms has a cosine of at most their length
    over the template's. The lightest terms are left out; with ``weights``
    those that are commonest in the corpus.
    """
    found: set[str] = set()
    for v in vectors:
        whole, light = sum(x * x for x in v.values()), 0.0
        for term, x in sorted(v.items(), key=lambda e: (weights[e[0]] if weights else e[1], e[0])):
            light += x * x
            if light >= (threshold**2 - 1e-9) * whole:
                found.add(term)
    return found


def one_of(words: set[str]) -> str:
    """A pattern of any of the words, their common beginnings tried once."""
    heads: dict[str, set[str]] = {}
    for w in words:
        heads.setdefault(w[:1], set()).add(w[1:])
    ends = heads.pop("", None) is not None
    each = [h + one_of(rest) for h, rest in sorted(heads.items())]
    if not each:
        return ""
    return f"(?:{'|'.join(each)})" + ("?" if ends else "") if len(each) > 1 or ends else each[0]


class _Templates:
    """Templates weighted by a corpus: idf times the number of a term, or, if ``damped``, 1 and the logarithm of that number.

    Whole licence texts need the damping, as their articles and prepositions,
    a hundred times each, would outweigh all that tells them apart.
    """

    def __init__(self, df: DataFrame, text_col: str, lines: tuple, threshold: float, damped: bool) -> None:
        bags: list[dict[str, int]] = []
        for _, line in lines:
            bag: dict[str, int] = {}
            for t in re.findall(TERM, line.lower()):
                bag[t] = bag.get(t, 0) + 1
            bags.append(bag)
        self.lines, self.threshold, self.damped = lines, threshold, damped
        self.weights, self.other = idf(df, text_col, sorted({t for b in bags for t in b}))
        self.vectors = [{t: (1 + math.log(n) if damped else n) * self.weights[t] for t, n in b.items()} for b in bags]
        self.anchor = f"(?<![a-z0-9]){one_of(anchors(self.vectors, threshold, self.weights if damped else None))}(?![a-z0-9])"

    def has(self, text: Column) -> Column:
        return F.lower(text).rlike(self.anchor)

    def match(self, parts: DataFrame, key: str, text: str) -> DataFrame:
        """(key, licence, score) of the parts that reach the threshold; the best template, on a tie the first.

        A cosine is at most the length of what the template has in common with
        the part, over the template's; parts that fall short by that alone are
        not counted out.
        """
        spark = parts.sparkSession
        unit = [
            (i, t, x / math.sqrt(sum(y * y for y in v.values()))) for i, v in enumerate(self.vectors) for t, x in sorted(v.items())
        ]
        sides = F.broadcast(constant_table(spark, unit, "template: int, term: string, y: double"))
        shared = parts.select(key, F.array_intersect(terms(F.col(text)), F.lit(sorted(self.weights))).alias("terms")).distinct()
        common = shared.select(key, F.explode("terms").alias("term")).join(sides, "term")
        able = common.groupBy(key, "template").agg(F.sum(F.col("y") * F.col("y")).alias("most")).where(F.col("most") >= self.threshold**2 - 1e-9)
        able = written(able.select(key).distinct(), "able")
        tf = F.count(F.lit(1))
        each = parts.join(able, key, "left_semi").select(key, text).distinct().select(key, F.explode(terms(F.col(text))).alias("term"))
        each = each.groupBy(key, "term").agg((1 + F.log(tf) if self.damped else tf).alias("tf"))
        known = constant_table(spark, sorted(self.weights.items()), "term: string, idf: double")
        each = each.join(F.broadcast(known), "term", "left").withColumn("x", F.col("tf") * F.coalesce("idf", F.lit(self.other)))
        dots = each.join(sides, "term").groupBy(key, "template").agg(F.sum(F.col("x") * F.col("y")).alias("dot"))
        norms = each.groupBy(key).agg(F.sqrt(F.sum(F.col("x") * F.col("x"))).alias("norm"))
        names = constant_table(spark, [(i, name) for i, (name, _) in enumerate(self.lines)], "template: int, licence: string")
        score = F.round(F.least(F.lit(1.0), F.col("dot") / F.col("norm")), 9)
        best = dots.join(norms, key).withColumn("score", score).where(F.col("score") >= self.threshold).groupBy(key).agg(
            F.max_by(F.struct("template", "score"), F.struct("score", -F.col("template"))).alias("best")
        )
        return best.select(key, "best.template", "best.score").join(F.broadcast(names), "template").select(key, "licence", "score")


def scan_lines(df: DataFrame, text_col: str, threshold: float = THRESHOLD) -> DataFrame:
    """(line, licence, score) of every distinct line of ``df``'s texts that states a licence; the best one, on a tie the first template."""
    known = _Templates(df, text_col, TEMPLATES, threshold, damped=False)
    lines = df.select(F.explode(F.split(text_col, r"\r\n|\r|\n")).alias("line")).where(known.has(F.col("line"))).distinct()
    return known.match(written(lines, "lines"), "line", "line")


COMMENT = r"^\s*(?:#|//|/\*|\*|--|;|%|<!--|\.\.|\"\"\"|'''|dnl\b|rem\b|$)"


def parts_of(text: Column) -> Column:
    """Lines, paragraphs, the leading comment and the whole of a text, as structs (kind, part)."""
    plain = F.regexp_replace(text, r"\r\n?", "\n")
    lines = F.split(plain, "\n")
    code = F.array_position(F.transform(lines, lambda x: F.lower(x).rlike(COMMENT)), F.lit(False))
    header = F.array_join(F.slice(lines, F.lit(1), F.when(code == 0, F.size(lines)).otherwise(code - 1).cast("int")), "\n")
    as_parts = lambda kind, parts: F.transform(parts, lambda x: F.struct(F.lit(kind).alias("kind"), x.alias("part")))
    return F.concat(
        as_parts("line", F.array_distinct(lines)), as_parts("paragraph", F.array_distinct(F.split(plain, "\n[^A-Za-z0-9]*\n"))),
        as_parts("header", F.array(header)), as_parts("whole", F.array(plain)),
    )


def _digest(text: Column) -> Column:
    return F.unhex(F.sha2(F.encode(text, "UTF-8"), 256))


def scan(
    df: DataFrame, id_col: str, text_col: str, path: Column, threshold: float = THRESHOLD, file_share: float = FILE_SHARE,
) -> DataFrame:
    """(id_col, path, licence, origin, score, licence_dir) for every row of ``df``.

    ``path`` names a row's file, its parts split by ``/``. ``origin`` is
    ``own``, ``inherited`` (then ``licence_dir`` is the directory it comes
    from) or ``none``. Of several licences a file or directory states, that of
    the highest score is taken, on a tie the first by name. A null text states
    none, a null path lies in no directory. Rows that repeat an id each get a
    row; other columns are ignored; an empty table gives an empty one.
    """
    # Texts and parts are named by their digests: equal ones state the same licence, and different ones never share a name.
    known = _Templates(df, text_col, TEMPLATES + BLOCKS, threshold, damped=True)
    files = df.select(F.col(id_col).alias("id"), path.alias("path"), _digest(F.col(text_col)).alias("key"))
    texts = written(df.select(F.col(text_col).alias("t")).where(known.has(F.col("t"))).select(_digest(F.col("t")).alias("key"), "t").distinct(), "licence-texts")
    # Parts are cut out of the texts twice, as most are only looked at once and would take several times the texts' room.
    cut = texts.select("key", F.size(terms(F.col("t"))).alias("words"), F.explode(parts_of(F.col("t"))).alias("p")).select("key", "words", "p.kind", "p.part")
    parts = cut.where(known.has(F.col("part"))).withColumn("name", _digest(F.col("part")))
    stated = written(known.match(parts.select("name", "part"), "name", "part"), "licence-matches")
    hits = parts.select("key", "words", "kind", "name", F.size(terms(F.col("part"))).alias("size")).join(stated, "name")
    own = hits.groupBy("key").agg(
        F.min_by(F.struct("licence", "score"), F.struct(-F.col("score"), F.col("licence"))).alias("best"),
        F.max("words").alias("words"), F.sum(F.when(F.col("kind") == "line", F.col("size")).otherwise(0)).alias("stated"),
        F.max(F.col("kind") == "whole").alias("near"),
    )
    own = written(own.select("key", "best.licence", "best.score", (F.col("near") | (F.col("stated") >= file_share * F.col("words"))).alias("whole")), "own")
    marked = written(
        files.select("id", "path", "key", F.regexp_extract("path", "^(.*)/[^/]*$", 1).alias("dir")).join(own, "key", "left").drop("key"), "files"
    )
    given = marked.where(F.col("whole") & F.col("path").isNotNull()).groupBy("dir").agg(
        F.min_by(F.struct("licence", "score"), F.struct(-F.col("score"), F.col("licence"))).alias("given")
    )
    dirs = marked.where(F.col("licence").isNull() & F.col("path").isNotNull()).select("dir").distinct()
    parts = F.split("dir", "/")
    above = dirs.select("dir", F.explode(F.sequence(F.lit(0), F.size(parts))).alias("depth")).withColumn(
        "up", F.array_join(F.slice(parts, F.lit(1), F.col("depth")), "/")
    )
    inherited = (
        above.join(given.withColumnRenamed("dir", "up"), "up")
        .groupBy("dir").agg(F.max_by(F.struct("given", "up"), "depth").alias("x"))
        .select("dir", F.col("x.given").alias("given"), F.col("x.up").alias("up"))
    )
    found = marked.join(written(inherited, "inherited"), "dir", "left")
    mine = F.col("licence").isNotNull()
    return found.select(
        F.col("id").alias(id_col), "path",
        F.when(mine, F.col("licence")).otherwise(F.col("given.licence")).alias("licence"),
        F.when(mine, "own").when(F.col("given").isNotNull(), "inherited").otherwise("none").alias("origin"),
        F.when(mine, F.col("score")).otherwise(F.col("given.score")).alias("score"),
        F.when(~mine, F.col("up")).alias("licence_dir"),
    )
