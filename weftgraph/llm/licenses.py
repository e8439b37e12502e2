"""Licence notices in documents, by a positional index of rare words.

One pass over the texts cuts them into words, finds the base phrases, and notes which
licence words a file has; for files that have all words of some template's key phrases it
also notes where.  Document frequencies of the licence words follow from these notes for
all documents.  Of each template, a file's highest-IDF words are then looked up in the
postings (template, word, place).  Places of file and template are intersected by their
difference, in overlapping windows, so a few words more or less in a notice do not matter.
A window stands for a notice if it holds enough of the rare words and every key phrase of
the template, word by word.

Only DataFrame functions work on documents.  The templates are fixed values of this
module; what is collected or broadcast has one row per template word.

Null texts are empty.  Every row gives one row, also where ids repeat or are null; columns
besides ``doc_id`` and ``text`` are not looked at.  ``score`` is 1 where a base phrase
stands, else the share of the best template's rare words that are in place, else 0.
"""

from __future__ import annotations

import math
import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from weftgraph.llm.common import stage

WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: What stands between words; cutting there is 15 times as fast as extracting them.
BETWEEN = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

# The phrases that count wherever they stand, and their labels.
BASE = [
    ("gnu general public license", "gpl"),
    ("apache license", "apache"),
    ("cc by", "cc-by"),
    ("mit license", "mit"),
]

# Licence notices (label, notice, key phrases of the notice).
TEMPLATES = [
    ("agpl-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation, either version 3 of the License", ["gnu affero general public license"]),
    ("apache-2.0", "Licensed under the Apache License, Version 2.0", ["apache license version 2 0"]),
    ("apache-2.0", "you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS", ["apache org licenses license 2 0"]),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.", ["redistribution and use in source and binary forms", "with or without modification"]),
    ("bsd-3-clause", "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission", ["neither the name of", "endorse or promote products derived from this software"]),
    ("bsl-1.0", "Distributed under the Boost Software License, Version 1.0", ["boost software license version 1 0"]),
    ("cc-by-4.0", "Licensed under CC BY 4.0", ["cc by 4 0"]),
    ("cc-by-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License", ["creative commons attribution 4 0"]),
    ("cc-by-nc-4.0", "Licensed under CC BY-NC 4.0", ["cc by nc 4 0"]),
    ("cc-by-nc-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License", ["creative commons attribution noncommercial 4 0"]),
    ("cc-by-nc-sa-4.0", "Licensed under CC BY-NC-SA 4.0", ["cc by nc sa 4 0"]),
    ("cc-by-nd-4.0", "Licensed under CC BY-ND 4.0", ["cc by nd 4 0"]),
    ("cc-by-sa-4.0", "Licensed under CC BY-SA 4.0", ["cc by sa 4 0"]),
    ("cc-by-sa-4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License", ["creative commons attribution sharealike 4 0"]),
    ("cc0-1.0", "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work. CC0 1.0 Universal", ["waived all copyright and related or neighboring rights"]),
    ("epl-2.0", "This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0", ["eclipse public license 2 0"]),
    ("gpl-2.0", "This work is licensed under the GNU General Public License, version 2", ["gnu general public license version 2"]),
    ("gpl-2.0-or-later", "it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version", ["gnu general public license as published by", "either version 2 of the license"]),
    ("gpl-3.0", "This work is licensed under the GNU General Public License, version 3", ["gnu general public license version 3"]),
    ("gpl-3.0-or-later", "it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version", ["gnu general public license as published by", "either version 3 of the license"]),
    ("isc", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies", ["permission to use copy modify", "distribute this software for any purpose with or without fee"]),
    ("lgpl", "it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation", ["gnu lesser general public license"]),
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software", ["permission is hereby granted free of charge", "deal in the software without restriction"]),
    ("mpl-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0", ["mozilla public license v 2 0"]),
    ("unlicense", "This is free and unencumbered software released into the public domain", ["free and unencumbered software released into the public domain"]),
    ("zlib", "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of this software", ["in no event will the authors be held liable"]),
]

#: Rare words of a template that are looked up, and the share of them that must be in place.
LOOKUPS, MIN_SHARE = 12, 0.5
#: Words by which places may be moved against the template within one window.
WINDOW = 16


def plain_words(text: str) -> list[str]:
    return re.findall(WORD, text.translate(str.maketrans(_UPPER, _LOWER)))


_NOTICES = [(label, plain_words(text), [p.split() for p in phrases]) for label, text, phrases in TEMPLATES]
#: (template, word, place) of every template word.
POSTINGS = [(t, w, i) for t, (_, words, _) in enumerate(_NOTICES) for i, w in enumerate(words)]
VOCABULARY = sorted({w for _, words, _ in _NOTICES for w in words} | {w for p, _ in BASE for w in p.split()})


def _strings(values: list[str]) -> Column:
    return F.array(*map(F.lit, values)).cast("array<string>")


def _has_all(own: Column, words: list[str]) -> Column:
    return F.size(F.array_except(_strings(sorted(set(words))), own)) == 0


def _base_places(words: Column) -> Column:
    """place * phrases + phrase, for each place where a base phrase starts."""

    def here(word: Column, at: Column) -> Column:
        found = None
        for n, (phrase, _) in enumerate(BASE):
            first, *others = phrase.split()
            same = word == first
            for i, other in enumerate(others, 1):
                same = same & (F.get(words, at + i) == other)
            found = (F.when if found is None else found.when)(same, at * len(BASE) + n)
        return found

    places = F.filter(F.transform(words, here), lambda p: p.isNotNull())
    return F.transform(places, lambda p: p.cast("long"))


def noted(docs: DataFrame) -> DataFrame:
    """One row per document: words, base places, licence words, and where these are in likely files."""
    text = F.translate(F.coalesce("text", F.lit("")), _UPPER, _LOWER)
    words = F.col("words")
    cut = docs.select("doc_id", F.array_remove(F.split(text, BETWEEN), "").alias("words"))
    own = cut.withColumn("own", F.array_intersect("words", _strings(VOCABULARY)))
    some_base = _has_all(F.col("own"), BASE[0][0].split())
    for phrase, _ in BASE[1:]:
        some_base = some_base | _has_all(F.col("own"), phrase.split())
    fitting = F.array(*[
        F.when(_has_all(F.col("own"), [w for p in phrases for w in p]), F.lit(t)) for t, (_, _, phrases) in enumerate(_NOTICES)
    ])
    likely = F.size("fitting") > 0
    at = F.filter(F.transform(words, lambda w, i: F.when(w.isin(VOCABULARY), i)), lambda i: i.isNotNull())
    hits = F.transform(at, lambda i: F.struct(i.alias("at"), F.get(words, i).alias("word")))
    none = F.array().cast("array<bigint>")
    return own.withColumn("fitting", F.array_compact(fitting)).select(
        F.monotonically_increasing_id().alias("row"),
        "doc_id",
        F.size("words").cast("long").alias("n_words"),
        F.when(some_base, _base_places(words)).otherwise(none).alias("places"),
        "own",
        "fitting",
        F.when(likely, hits).alias("hits"),
    )


def rarities(notes: DataFrame) -> dict[str, float]:
    """IDF of every licence word over all documents."""
    counted = notes.select(F.explode(F.concat(F.array(F.lit("")), "own")).alias("word")).groupBy("word").count().collect()
    known = {r["word"]: r["count"] for r in counted}
    total = known.get("", 0)
    return {w: math.log((1 + total) / (1 + known.get(w, 0))) for w in VOCABULARY}


def key_phrases() -> list[tuple]:
    """(template, phrase, length, word, place in the template) of every word of a key phrase."""
    rows = []
    for t, (_, words, keys) in enumerate(_NOTICES):
        for n, key in enumerate(keys):
            start = next(i for i in range(len(words)) if words[i : i + len(key)] == key)
            rows += [(t, n, len(key), w, start + i) for i, w in enumerate(key)]
    return rows


def values_list(rows: list[tuple]) -> str:
    return ", ".join("(" + ", ".join(f"'{v}'" if isinstance(v, str) else str(v) for v in row) + ")" for row in rows)


def _values(spark: SparkSession, rows: list[tuple], columns: str) -> DataFrame:
    """Fixed rows as a table that is part of the plan."""
    return spark.sql(f"SELECT * FROM VALUES {values_list(rows)} AS t({columns})")


def notices(notes: DataFrame) -> DataFrame:
    """(row, label, score): the notices of likely files that the index finds and the phrases confirm."""
    spark, rarity = notes.sparkSession, rarities(notes)
    ranked = [sorted(set(words), key=lambda w: (-rarity[w], w)) for _, words, _ in _NOTICES]
    likely = notes.where("size(fitting) > 0").select("row", "own", "hits", F.explode("fitting").alias("template"))
    case = F.create_map(*[x for t, words in enumerate(ranked) for x in (F.lit(t), _strings(words))])
    rare = F.slice(F.array_intersect(F.element_at(case, F.col("template")), F.col("own")), 1, LOOKUPS)
    likely = likely.select("row", "template", "hits", rare.alias("rare"))

    def windows(df: DataFrame, shift: Column, *keep: str) -> DataFrame:
        """Each row in the two windows that its shift lies in."""
        two = [F.struct(F.lit(g).alias("grid"), F.floor((shift + g * (WINDOW // 2)) / WINDOW).alias("cell")) for g in (0, 1)]
        return df.select("row", "template", *keep, F.explode(F.array(*two)).alias("w")).select("row", "template", "w.*", *keep)

    postings = F.broadcast(_values(spark, POSTINGS, "template, word, place"))
    looked = F.filter("hits", lambda h: F.array_contains(F.col("rare"), h["word"]))
    found = likely.select("row", "template", F.explode(looked).alias("hit"))
    found = found.select("row", "template", "hit.at", "hit.word").join(postings, ["template", "word"])
    found = windows(found, F.col("at") - F.col("place"), "word").distinct()
    share = F.count(F.lit(1)) / F.element_at(
        F.array(*[F.lit(min(LOOKUPS, len(words))) for words in ranked]), F.col("template") + 1
    )
    found = found.groupBy("row", "template", "grid", "cell").agg(share.alias("share")).where(F.col("share") >= MIN_SHARE)

    phrase_words = F.create_map(*[
        x for t, (_, _, keys) in enumerate(_NOTICES) for x in (F.lit(t), _strings(sorted({w for k in keys for w in k})))
    ])
    phrases = F.broadcast(_values(spark, key_phrases(), "template, phrase, length, word, place"))
    spoken = F.filter("hits", lambda h: F.array_contains(F.element_at(phrase_words, F.col("template")), h["word"]))
    said = likely.select("row", "template", F.explode(spoken).alias("hit"))
    said = said.select("row", "template", "hit.at", "hit.word").join(phrases, ["template", "word"])
    # All words of a phrase stand in a row where they have the same shift.
    said = said.groupBy("row", "template", "phrase", "length", (F.col("at") - F.col("place")).alias("shift")).count()
    said = windows(said.where("count = length"), F.col("shift"), "phrase").distinct()
    said = said.groupBy("row", "template", "grid", "cell").agg(F.count(F.lit(1)).alias("confirmed"))
    wanted = F.element_at(F.array(*[F.lit(len(keys)) for _, _, keys in _NOTICES]), F.col("template") + 1)
    both = found.join(said.where(F.col("confirmed") == wanted), ["row", "template", "grid", "cell"])
    label = F.element_at(_strings([label for label, _, _ in _NOTICES]), F.col("template") + 1)
    return both.groupBy("row", label.alias("label")).agg(F.max("share").alias("score"))


def scan_licenses(docs: DataFrame) -> DataFrame:
    """(doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score) for each row."""
    notes = stage(noted(docs), "license-notes")
    # At most one element per template.
    found = notices(notes).groupBy("row").agg(F.collect_set("label").alias("added"), F.max("score").alias("best"))
    found = notes.select("row", "doc_id", "n_words", "places").join(stage(found, "license-notices"), "row", "left")
    label = _strings([label for _, label in BASE])
    base = F.array_distinct(F.transform("places", lambda p: F.element_at(label, (p % len(BASE)).cast("int") + 1)))
    start = lambda place: F.floor(place / len(BASE))
    every = F.array_union(base, F.coalesce("added", F.array().cast("array<string>")))
    return found.select(
        "doc_id",
        "n_words",
        F.size("places").cast("long").alias("n_base"),
        start(F.array_min("places")).alias("first_word"),
        start(F.array_max("places")).alias("last_word"),
        F.array_join(F.array_sort(base), ",").alias("base_labels"),
        F.array_join(F.array_sort(every), ",").alias("labels"),
        F.when(F.size("places") > 0, F.lit(1.0)).otherwise(F.coalesce("best", F.lit(0.0))).alias("score"),
    )
