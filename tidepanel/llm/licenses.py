"""License detection by diagonal voting over rolling word k-gram hashes, in DataFrame functions only."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import written

NOT_WORD = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
K = 3
BROADCAST_CHARS = 1 << 20  # of templates, a row of about 100 bytes for each word

#: Phrases whose every place counts, and their labels.
PHRASES = {"under the mit license": "mit", "apache license version 2": "apache-2", "cc by nc": "cc-by-nc"}

#: Texts of short public licences (the BSD ones up to their liability clause), and notices of one sentence that works under longer ones carry, by label.
TEMPLATES = {
    "mit": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the Software), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software",
        """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:
        The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.
        THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.""",
    ),
    "bsd-2": """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:
        1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.
        2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.
        THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED.""",
    "bsd-3": """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:
        1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.
        2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.
        3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.
        THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED.""",
    "zlib": """This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of this software.
        Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions:
        1. The origin of this software must not be misrepresented; you must not claim that you wrote the original software. If you use this software in a product, an acknowledgment in the product documentation would be appreciated but is not required.
        2. Altered source versions must be plainly marked as such, and must not be misrepresented as being the original software.
        3. This notice may not be removed or altered from any source distribution.""",
    "agpl": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation",
    "cc0": "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work",
    "cc-by-nc-sa": "This work is licensed under a Creative Commons Attribution-NonCommercial-ShareAlike 4.0 International License",
    "cc-by-nd": "This work is licensed under a Creative Commons Attribution-NoDerivatives 4.0 International License",
    "apache-2": "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance with the License. You may obtain a copy of the License at",
    "bsd": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met",
    "gpl": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation",
    "gpl-3": "licensed under the GNU General Public License, version 3",
    "lgpl": "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation",
    "mpl-2": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0",
    "isc": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies",
        """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.
        THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.""",
    ),
    "cc-by": "This work is licensed under a Creative Commons Attribution 4.0 International License",
    "cc-by-nc": "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License",
    "cc-by-sa": "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License",
    "unlicense": "This is free and unencumbered software released into the public domain",
}


def template_words(text: str) -> list[str]:
    return [w for w in re.split(NOT_WORD, re.sub("[A-Z]", lambda m: m[0].lower(), text)) if w]


def _template_table(spark: SparkSession, phrases: dict[str, str], templates: dict[str, str | tuple[str, ...]]) -> DataFrame:
    """A row for each k-gram of each template: template, label, base, grams, length, tpos, g1..g3, gram. Its size is that of the templates given."""
    rows, number = [], 0
    several = [(label, text) for label, texts in templates.items() for text in ([texts] if isinstance(texts, str) else texts)]
    for base, texts in ((True, [(label, phrase) for phrase, label in phrases.items()]), (False, several)):
        for label, text in texts:
            words = template_words(text)
            if len(words) < K:
                raise ValueError(f"a template needs {K} words: {text!r}")
            rows += [(number, label, base, len(words) - K + 1, p, words[p : p + K]) for p in range(len(words) - K + 1)]
            number += 1
    table = spark.createDataFrame(rows, "template int, label string, base boolean, grams int, tpos int, twords array<string>")
    return table.withColumn("gram", gram_hash(*[F.xxhash64(F.get("twords", F.lit(i))) for i in range(K)]))


def gram_hash(*hashes: Column) -> Column:
    return F.xxhash64(*hashes)


def license_spans(
    documents: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    phrases: dict[str, str] = PHRASES,
    templates: dict[str, str | tuple[str, ...]] = TEMPLATES,
    least_cover: float = 0.6,
    gap: int = 3,
) -> DataFrame:
    """Verified spans: id, label, base, first (word position), last (its last word), cover (0 to 1).

    Each document's rolling word 3-gram hashes meet the template positions in a join with the small
    template table; a match's words are compared as they stand. Matches vote for the diagonal
    document position - template position. For phrases a diagonal with every vote is a place. For
    longer templates diagonals at most `gap` apart are merged, so that small insertions and losses do
    not part a span, and a span is kept when its distinct template positions cover `least_cover` of
    the template within 1.5 times its length. Related licences share most of their words: where spans
    of several labels overlap, they are settled in order of their matched positions. A label may have several texts.

    The work is linear in the words of a text, as a gram's row has its own words only. A null text has no
    span; rows of one id are taken together, and so are those without an id.
    """
    table = _template_table(documents.sparkSession, phrases, templates)
    table = F.broadcast(table) if sum(len(t) for v in templates.values() for t in ([v] if isinstance(v, str) else v)) < BROADCAST_CHARS else table
    docs = documents.select(F.col(id_column).alias("_id"), F.split(F.col(text_column), NOT_WORD).alias("w")).where(F.col(text_column).isNotNull())
    docs = docs.withColumn("w", F.filter("w", lambda x: x != ""))
    docs = docs.where(F.size("w") >= K).withColumn("h", F.transform(F.col("w"), lambda x: F.xxhash64(F.lower(x))))
    gram = lambda x, i: F.struct(gram_hash(x, *[F.get("h", i + j) for j in range(1, K)]).alias("gram"), *[F.get("w", i + j).alias(f"w{j}") for j in range(K)])
    grams = docs.select("_id", F.posexplode(F.transform("h", gram)).alias("pos", "at")).select("_id", "pos", "at.*")
    hits = grams.join(table, "gram")
    as_ascii = lambda x: F.translate(x, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    for i in range(K):
        hits = hits.where(as_ascii(F.col(f"w{i}")) == F.get("twords", F.lit(i)))
    hits = hits.select("_id", "template", "label", "base", "grams", "pos", "tpos", (F.col("pos") - F.col("tpos")).alias("diagonal"))

    votes = hits.groupBy("_id", "template", "label", "base", "grams", "diagonal").agg(
        F.collect_set("tpos").alias("seen"), F.min("pos").alias("first"), (F.max("pos") + K - 1).alias("last")
    )
    votes, _ = written(votes, "votes")  # few rows, read twice below
    places = votes.where(F.col("base") & (F.size("seen") == F.col("grams"))).select("_id", "label", "base", "first", "last", F.lit(1.0).alias("cover"))
    line = Window.partitionBy("_id", "template").orderBy("diagonal")
    apart = (F.col("diagonal") - F.lag("diagonal").over(line) > gap).cast("int")
    merged = votes.where(~F.col("base")).withColumn("island", F.sum(F.coalesce(apart, F.lit(0))).over(line))
    merged = merged.groupBy("_id", "template", "label", "base", "grams", "island").agg(
        F.size(F.array_distinct(F.flatten(F.collect_list("seen")))).alias("covered"), F.min("first").alias("first"), F.max("last").alias("last")
    )
    kept = merged.where((F.col("covered") >= F.col("grams") * least_cover) & (F.col("last") - F.col("first") + 1 <= (F.col("grams") + K - 1) * 1.5))
    kept = kept.select("_id", "label", "first", "last", "covered", (F.col("covered") / F.col("grams")).alias("cover"))
    kept = settled(kept).select("_id", "label", F.lit(False).alias("base"), "first", "last", "cover")
    return places.unionByName(kept).withColumnRenamed("_id", id_column)


def settled(spans: DataFrame) -> DataFrame:
    """Of overlapping spans of several labels those that stay, settled in order of rank: most matched positions, better cover, first label.

    A span goes if it overlaps one of another label that stays; one that went itself beats no other. Spans that
    form a chain of overlaps are settled together, and such a chain is as long as the licences that follow each other.
    """
    line = Window.partitionBy("_id").orderBy("first", "last").rowsBetween(Window.unboundedPreceding, -1)
    begins = F.coalesce((F.col("first") > F.max("last").over(line)).cast("int"), F.lit(0))
    chained = spans.withColumn("_begins", begins).withColumn("_chain", F.sum("_begins").over(Window.partitionBy("_id").orderBy("first", "last")))
    ranked = F.array_sort(F.collect_list(F.struct((-F.col("covered")).alias("rank"), (-F.col("cover")).alias("worse"), "label", "first", "last", "cover")))
    none = F.filter(F.col("ranked"), lambda x: F.lit(False))
    clash = lambda x: lambda y: (y["label"] != x["label"]) & (y["first"] <= x["last"]) & (x["first"] <= y["last"])
    stay = F.aggregate("ranked", none, lambda kept, x: F.when(F.exists(kept, clash(x)), kept).otherwise(F.array_append(kept, x)))
    return chained.groupBy("_id", "_chain").agg(ranked.alias("ranked")).select("_id", F.inline(stay)).select("_id", "label", "first", "last", "cover")


def scan_licenses(documents: DataFrame, id_column: str = "doc_id", text_column: str = "text", **options) -> DataFrame:
    """One row per id: n_words, n_base, first_word, last_word, base_labels, labels, score.

    first_word and last_word are the smallest and largest start of a base phrase; labels are distinct,
    sorted and comma-joined, '' for none; score is the best cover, 1 where a base phrase stands. A
    null text is empty; rows that repeat an id are one document, whose n_words is the longest row's
    and whose places are those of any row; rows without an id are left out; an empty table gives no
    rows. Only matches move, never texts.
    """
    documents = documents.where(F.col(id_column).isNotNull())
    spans = license_spans(documents, id_column, text_column, **options)
    words = F.filter(F.split(F.coalesce(F.col(text_column), F.lit("")), NOT_WORD), lambda x: x != "")
    sizes = documents.groupBy(id_column).agg(F.max(F.size(words)).cast("long").alias("n_words"))
    base = F.when(F.col("base"), F.col("first"))
    found = spans.groupBy(id_column).agg(
        F.sum(F.col("base").cast("long")).alias("n_base"), F.min(base).cast("long").alias("first_word"), F.max(base).cast("long").alias("last_word"),
        F.array_join(F.array_sort(F.collect_set(F.when(F.col("base"), F.col("label")))), ",").alias("base_labels"),
        F.array_join(F.array_sort(F.collect_set("label")), ",").alias("labels"), F.max("cover").alias("score"),
    )
    return sizes.join(found, id_column, "left").select(
        id_column, "n_words", F.coalesce("n_base", F.lit(0)).cast("long").alias("n_base"), "first_word", "last_word",
        F.coalesce("base_labels", F.lit("")).alias("base_labels"), F.coalesce("labels", F.lit("")).alias("labels"), F.coalesce("score", F.lit(0.0)).alias("score"),
    )
