"""Licence scans.

The units of a text are its lines, the sentences of its lines, and the sentences of its paragraphs, which may run over
several lines. Each unit is compared with the units of licence templates by the cosine of sparse TF-IDF vectors; document
frequencies are counted over the whole corpus, for all tokens. Versions and the words that tell variants of a licence
apart decide between near templates: a unit is compared only with templates whose versions and variants it states, and
that state its variants. A unit as near to two licences names neither. A file without a licence of its own takes that of the
licence file in the nearest directory above it, found by joining its ancestors' paths with the directories of licence
files.
"""

from __future__ import annotations

import math
import re
from collections import Counter

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from laddermill.llm.common import counted, let, materialize, small, table

#: Notices, headers and texts of common licences.
TEMPLATES = {
    "Apache-2.0": """Licensed under the Apache License, Version 2.0.
        Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License.
        You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0
        Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.""",
    "Apache-1.1": """Licensed under the Apache Software License, Version 1.1.""",
    "GPL-3.0": """This work is licensed under the GNU General Public License, version 3.
        This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.
        You should have received a copy of the GNU General Public License along with this program.""",
    "GPL-2.0": """This work is licensed under the GNU General Public License, version 2.
        This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version.
        This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2
        either version 2 of the License, or (at your option) any later version.
        You should have received a copy of the GNU General Public License along with this program.""",
    "LGPL-3.0": """This work is licensed under the GNU Lesser General Public License, version 3.
        This library is free software: you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.
        You should have received a copy of the GNU Lesser General Public License along with this library.""",
    "LGPL-2.1": """This work is licensed under the GNU Lesser General Public License, version 2.1.
        This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation; either version 2.1 of the License, or (at your option) any later version.
        either version 2.1 of the License, or (at your option) any later version.
        You should have received a copy of the GNU Lesser General Public License along with this library.""",
    "AGPL-3.0": """This work is licensed under the GNU Affero General Public License, version 3.
        This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.
        You should have received a copy of the GNU Affero General Public License along with this program.""",
    "GFDL-1.3": """Permission is granted to copy, distribute and/or modify this document under the terms of the GNU Free Documentation License, Version 1.3 or any later version published by the Free Software Foundation.""",
    "MIT": """Released under the MIT License.
        Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:
        The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.""",
    "MIT-0": """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so.""",
    "0BSD": """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted.""",
    "ISC": """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.""",
    "CC-BY-NC-4.0": """Licensed under CC BY-NC 4.0.
        This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.""",
    "CC-BY-4.0": """Licensed under CC BY 4.0.
        This work is licensed under a Creative Commons Attribution 4.0 International License.""",
    "CC-BY-SA-4.0": """Licensed under CC BY-SA 4.0.
        This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.""",
    "CC-BY-ND-4.0": """Licensed under CC BY-ND 4.0.
        This work is licensed under a Creative Commons Attribution-NoDerivatives 4.0 International License.""",
    "CC-BY-NC-SA-4.0": """Licensed under CC BY-NC-SA 4.0.
        This work is licensed under a Creative Commons Attribution-NonCommercial-ShareAlike 4.0 International License.""",
    "CC-BY-NC-ND-4.0": """Licensed under CC BY-NC-ND 4.0.
        This work is licensed under a Creative Commons Attribution-NonCommercial-NoDerivatives 4.0 International License.""",
    "CC0-1.0": """To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work.
        This work is dedicated to the public domain under CC0 1.0 Universal.""",
    "BSD-2-Clause": """Licensed under the BSD 2-Clause License.
        Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:
        Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.""",
    "BSD-3-Clause": """Use of this source code is governed by a BSD-style license.
        Licensed under the BSD 3-Clause License.
        Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:
        Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.
        Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.""",
    "MPL-2.0": """This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.
        If a copy of the MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/.""",
    "MPL-1.1": """The contents of this file are subject to the Mozilla Public License Version 1.1 (the "License"); you may not use this file except in compliance with the License.""",
    "EPL-2.0": """This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0 which is available at https://www.eclipse.org/legal/epl-2.0/""",
    "EPL-1.0": """All rights reserved. This program and the accompanying materials are made available under the terms of the Eclipse Public License v1.0 which accompanies this distribution.""",
    "CDDL-1.0": """The contents of this file are subject to the terms of the Common Development and Distribution License, Version 1.0 only (the "License").""",
    "BSL-1.0": """Distributed under the Boost Software License, Version 1.0.""",
    "Artistic-2.0": """This program is free software; you can redistribute it and/or modify it under the terms of the Artistic License 2.0.""",
    "OFL-1.1": """This Font Software is licensed under the SIL Open Font License, Version 1.1.""",
    "EUPL-1.2": """Licensed under the European Union Public Licence, Version 1.2.""",
    "Zlib": """This software is provided 'as-is', without any express or implied warranty.
        The origin of this software must not be misrepresented; you must not claim that you wrote the original software.""",
    "WTFPL": """Everyone is permitted to copy and distribute verbatim or modified copies of this license document, and changing it is allowed as long as the name is changed.""",
    "Unlicense": """This is free and unencumbered software released into the public domain.
        Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means.""",
    "LicenseRef-reserved": "All rights reserved.",
}
#: Words that tell variants of a licence apart.
VARIANTS = ("affero", "lesser", "library", "sharealike", "noncommercial", "noderivatives", "sa", "nc", "nd")
#: Versions, as tokens.
VERSION = r"v?[0-9](\.[0-9])*"
LEAST = 0.7
#: How many of the corpus's most frequent tokens come to the driver, whose weights bound those of all others.
FREQUENT = 1000
TOKEN = r"[\p{L}\p{N}]+(?:[.][\p{N}]+)*"
SENTENCE = r"(?<=[.;:!?])\s+"
#: File names of licence files.
NOTICE_FILE = r"(?i)(^|/)(licen[cs]e|copying|notice|unlicense)(\.[a-z]+)?$"


def tokens(text: str) -> list[str]:
    return re.findall(r"[^\W_]+(?:\.[0-9]+)*", text.lower())


def template_units() -> list[tuple[str, Counter]]:
    """(licence, tokens and how often) of each line of the templates."""
    return [(name, Counter(tokens(line))) for name, text in TEMPLATES.items() for line in text.split("\n")]


def decisive(unit: Counter) -> tuple[int, int]:
    """How many different versions and how many different variants a template's unit states."""
    return sum(bool(re.fullmatch(VERSION, t)) for t in unit), sum(t in VARIANTS for t in unit)


def vocabulary() -> list[str]:
    return sorted({t for _, unit in template_units() for t in unit})


def document_frequencies(files: DataFrame) -> DataFrame:
    """token, df: in how many rows of files (text) each token is, over all tokens of the corpus."""
    found = F.array_distinct(F.regexp_extract_all(F.lower(F.coalesce("text", F.lit(""))), F.lit(TOKEN), F.lit(0)))
    return files.select(F.explode(found).alias("token")).groupBy("token").agg(F.count(F.lit(1)).alias("df"))


def template_weights(df: DataFrame, n: int) -> dict[str, float]:
    """The weight of each token of the templates among n documents; only these come to the driver."""
    known = {r["token"]: r["df"] for r in df.filter(F.col("token").isin(vocabulary())).collect()}
    return {t: math.log((n + 1) / (known.get(t, 0) + 1)) + 1 for t in vocabulary()}


def frequent_tokens(df: DataFrame, n: int) -> list[tuple[float, list[str]]]:
    """(bound, tokens) of the FREQUENT most frequent tokens outside the templates: their weights are the bound or more.

    The last has no tokens, as its bound holds for all others.
    """
    top = df.filter(~F.col("token").isin(vocabulary())).orderBy(F.desc("df"), "token").limit(FREQUENT).collect()
    weight = {r["token"]: math.log((n + 1) / (r["df"] + 1)) + 1 for r in top}
    bounds = {t: math.floor(2 * w) / 2 for t, w in weight.items()}
    return [(b, [t for t in bounds if bounds[t] == b]) for b in sorted(set(bounds.values()))] + [(max(weight.values(), default=1.0), [])]


def template_parts(spark: SparkSession, weights: dict[str, float]) -> DataFrame:
    """One row, parts: for each token of the vocabulary, what one of it adds to the product with each template's unit vector."""
    found = template_units()
    norms = [sum((k * weights[t]) ** 2 for t, k in unit.items()) ** 0.5 or 1.0 for _, unit in found]
    rows = (", ".join(f"{unit[t] * weights[t] ** 2 / norm!r}D" for (_, unit), norm in zip(found, norms, strict=True)) for t in vocabulary())
    return spark.sql(f"select array({', '.join(f'array({row})' for row in rows)}) as parts")


def key_tokens(weights: dict[str, float], least: float) -> list[str]:
    """Tokens of which every unit with a cosine of `least` or more to a template's has one.

    The cosine is at most the share of the template's norm that lies in the shared tokens. So of each template's unit the
    heaviest tokens are taken until the others have a smaller share of its norm than `least`.
    """
    found = set()
    for _, unit in template_units():
        squares = sorted(((k * weights[t]) ** 2, t) for t, k in unit.items())
        total, rest = sum(x for x, _ in squares), 0.0
        for x, t in squares:
            rest += x
            if rest >= (least * (1 - 1e-9)) ** 2 * total:
                found.add(t)
    return sorted(found)


def units(files: DataFrame) -> DataFrame:
    """doc_id, first_line, unit of files (doc_id, text): each different unit once; first_line: it begins the text."""
    text = F.coalesce("text", F.lit(""))
    lines, paragraphs = F.split(text, "\n"), F.split(text, r"\n[ \t\r]*\n")
    piece = lambda first, unit: F.struct(first.alias("first_line"), unit.alias("unit"))
    whole = F.transform(lines, lambda x, i: piece(i == 0, x))
    inside = F.flatten(F.transform(lines, lambda x, i: F.transform(F.split(x, SENTENCE), lambda y: piece(i == 0, y))))
    across = F.flatten(F.transform(paragraphs, lambda x, i: F.transform(F.split(F.regexp_replace(x, r"\s*\n\s*", " "), SENTENCE), lambda y, j: piece((i == 0) & (j == 0), y))))
    return files.select("doc_id", F.explode(F.array_distinct(F.concat(whole, inside, across))).alias("u")).select("doc_id", "u.*")


def alternatives(words: list[str]) -> str:
    """A pattern for one of the words, which tries their common beginnings once."""
    by_first = {c: [w[1:] for w in words if w[:1] == c] for c in sorted({w[:1] for w in words})}
    parts = [re.escape(c) + alternatives(rest) for c, rest in by_first.items() if c]
    return "" if not parts else f"(?:{'|'.join(parts)}){'?' if '' in words else ''}"


def candidates(files: DataFrame, weights: dict[str, float], least: float, frequent: list[tuple[float, list[str]]]) -> DataFrame:
    """doc_id, first_line, tokens, key (their hash) of the units that can have a cosine of `least` or more.

    Such a unit has a key token. And with h tokens of the vocabulary and o others, whose weights are 1 or more, its
    cosine is at most the share of its norm in the vocabulary, sqrt(s / (s + o)) where s is at most (h * heaviest) ** 2.
    What is left is compared with every template: the products and the part of the norm in the vocabulary are exact, only
    the weights of other tokens are replaced by their bounds.
    """
    keys, heaviest, known = key_tokens(weights, least), max(weights.values()), vocabulary()
    has_key = rf"(?<![\p{{L}}\p{{N}}]){alternatives(keys)}(?![\p{{L}}\p{{N}}])"
    found = units(files.filter(F.lower("text").rlike(has_key))).withColumn("unit", F.lower("unit")).filter(F.col("unit").rlike(has_key))
    found = found.withColumn("tokens", F.regexp_extract_all("unit", F.lit(TOKEN), F.lit(0))).withColumn("h", F.size(F.filter("tokens", lambda x: x.isin(known))))
    most = F.pow(F.col("h") * heaviest, 2.0) * (1 / least**2 - 1 + 1e-9)
    found = found.filter((F.size("tokens") - F.col("h")) <= most).select("doc_id", "first_line", "tokens")
    place = lambda r: F.array_position(F.lit(known), r.value).cast("int") - 1
    highest = lambda runs: F.array_max(F.aggregate(runs, F.array_repeat(F.lit(0.0), len(template_units())), lambda a, r: F.zip_with(a, F.get("parts", place(r)), lambda x, y: x + r.n * y)))
    square = lambda runs, weight: F.aggregate(runs, F.lit(0.0), lambda a, r: a + F.pow(r.n * weight(r), 2.0))
    exact = lambda r: F.get(F.lit([weights[t] for t in known]), place(r))
    *levels, (rest, _) = frequent
    bound = lambda r: F.coalesce(*(F.when(r.value.isin(ts), F.lit(b)) for b, ts in levels), F.lit(rest))
    others = square(counted(F.filter("tokens", lambda x: ~x.isin(known))), bound)
    near = let(counted(F.filter("tokens", lambda x: x.isin(known))), lambda runs: highest(runs) >= least * (1 - 1e-9) * F.sqrt(square(runs, exact) + others))
    found = found.crossJoin(F.broadcast(materialize(template_parts(files.sparkSession, weights), "template-parts"))).filter(near)
    return found.select("doc_id", "first_line", "tokens", F.sha2(F.array_join("tokens", " "), 256).alias("key"))


def scores(kinds: DataFrame, df: DataFrame, weights: dict[str, float], n: int) -> DataFrame:
    """key, score, license: the nearest licence of each row of kinds (key, tokens) and its cosine, among n documents.

    Compared are templates of which the row states every version and every variant, and that state all its variants. A
    row as near to several licences has license null. The frequencies are joined to the rows' tokens; the templates'
    weights, an inverted index of about a thousand rows, are broadcast.
    """
    tf = kinds.select("key", F.inline(counted(F.col("tokens"))).alias("token", "n"))
    weighted = tf.join(df, "token").select("key", "token", (F.col("n") * (F.log(F.lit(n + 1) / (F.col("df") + 1)) + 1)).alias("weight"))
    norms = weighted.groupBy("key").agg(F.sqrt(F.sum(F.pow("weight", 2.0))).alias("norm"), F.count_if(F.col("token").isin(*VARIANTS)).alias("stated"))
    index, names = [], sorted(TEMPLATES)
    for i, (name, unit) in enumerate(template_units()):
        norm = sum((k * weights[t]) ** 2 for t, k in unit.items()) ** 0.5
        versions, variants = decisive(unit)
        index += [f"('{t}', {i}, {names.index(name)}, {k * weights[t] / norm!r}D, {int(bool(re.fullmatch(VERSION, t)))}, {versions}, {int(t in VARIANTS)}, {variants})" for t, k in unit.items()]
    index = kinds.sparkSession.sql(f"select * from values {', '.join(index)} as t(token, nth, name, part, version, versions, variant, variants)")
    dots = weighted.join(F.broadcast(index), "token").groupBy("key", "nth", "name", "versions", "variants").agg(F.sum(F.col("weight") * F.col("part")).alias("dot"), F.sum("version").alias("v"), F.sum("variant").alias("w"))
    fit = dots.filter("v = versions and w = variants").join(norms, "key").filter("variants = stated")
    score = F.round(F.col("dot") / F.col("norm"), 9)
    best = fit.groupBy("key").agg(F.max(F.struct(score.alias("score"), "name")).alias("s"), F.max(F.struct(score.alias("score"), (-F.col("name")).alias("name"))).alias("t"))
    name = F.when(F.col("s.name") == -F.col("t.name"), F.element_at(F.array(*map(F.lit, names)), F.col("s.name") + 1))
    return best.select("key", "s.score", name.alias("license"))


def own_licenses(files: DataFrame, least: float = LEAST) -> DataFrame:
    """doc_id, score, license, first_line of each file with a unit that is a licence notice: the best unit's.

    files: doc_id, text. Of equally good units that of the last licence in the alphabet is the best, then one that begins
    the text. Units as near to several licences don't count.
    """
    df = materialize(document_frequencies(files), "document-frequencies")
    n = files.count()
    weights = template_weights(df, n)
    found = materialize(candidates(files, weights, least, frequent_tokens(df, n)), "license-units")
    best = scores(found.select("key", "tokens").dropDuplicates(["key"]), df, weights, n).filter((F.col("score") >= least) & F.col("license").isNotNull())
    top = found.join(best, "key").groupBy("doc_id").agg(F.max(F.struct("score", "license", "first_line")).alias("s"))
    return top.select("doc_id", "s.score", "s.license", "s.first_line")


def scan(files: DataFrame, least: float = LEAST) -> DataFrame:
    """One row per row of files (doc_id, path, text): doc_id, path, license, score, found_in.

    A licence of the file's own has found_in = its path. A file that begins with a notice, or has one and the name of a
    licence file, is the licence file of its directory (of several, the best by score, then the smallest doc_id); files without a licence of their own take that
    of the nearest directory above them that has one: found_in is the directory, score its notice's. No licence: nulls.
    A null path has no directories; null and empty texts have no licence of their own. Rows that repeat a doc_id share
    their units' best licence; other columns are ignored.
    """
    own = materialize(own_licenses(files, least), "own-licenses")
    place = files.select("doc_id", "path").join(own, "doc_id", "left")
    folder = F.regexp_extract("path", "^(.*)/[^/]*$", 1)
    notices = files.select("doc_id", "path").join(own, "doc_id").filter("path like '%/%'").filter(F.col("first_line") | F.col("path").rlike(NOTICE_FILE))
    by_folder = notices.groupBy(folder.alias("folder")).agg(F.max(F.struct("score", (-F.col("doc_id")).alias("least"), "license")).alias("of"))
    parts = F.split(folder, "/")
    above = F.transform(F.sequence(F.lit(1), F.size(parts)), lambda k: F.array_join(F.slice(parts, 1, k), "/"))
    bare = place.filter("license is null and path like '%/%'").select("doc_id", "path", F.explode(above).alias("folder"))
    nearest = bare.join(small(materialize(by_folder, "license-folders")), "folder").groupBy("doc_id", "path").agg(F.max(F.struct(F.length("folder").alias("depth"), "folder", "of")).alias("n"))
    found = nearest.select(F.col("doc_id").alias("_id"), F.col("path").alias("_path"), F.col("n.of.license").alias("_license"), F.col("n.of.score").alias("_score"), F.col("n.folder").alias("_folder"))
    same = F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("path") == F.col("_path"))
    source = F.when(F.col("license").isNotNull(), F.col("path")).otherwise(F.col("_folder"))
    return place.join(found, same, "left").select("doc_id", "path", F.coalesce("license", "_license").alias("license"), F.round(F.coalesce("score", "_score"), 6).alias("score"), source.alias("found_in"))


def with_paths(docs: DataFrame) -> DataFrame:
    """The documents as files: source/language/thousand/hundred/doc_id.txt."""
    step = lambda n: F.floor(F.col("doc_id") / n).cast("string")
    path = F.concat_ws("/", F.coalesce("source", F.lit("unknown")), F.coalesce("lang", F.lit("unknown")), step(1000), step(100), F.concat(F.col("doc_id").cast("string"), F.lit(".txt")))
    return docs.select("doc_id", path.alias("path"), "text")


def op5_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan(with_paths(table(spark, sf_dir, "documents")))


QUERIES = {"op5_license_scan": op5_license_scan}
ORACLE: dict[str, str] = {}
