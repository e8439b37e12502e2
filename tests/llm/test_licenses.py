"""Licence notices against a plain search, and odd texts."""

from __future__ import annotations

import math
import re
from collections import defaultdict

from weftgraph.llm import licenses
from weftgraph.llm.common import importable

DOCS = "doc_id bigint, text string, lang string, words int, row int, own string, hits string, template int, score string"
FILL = "so the quick brown fox of the wood goes to a hill and back"
MIT = next(text for label, text, _ in licenses.TEMPLATES if label == "mit")
BSD3 = next(text for label, text, _ in licenses.TEMPLATES if label == "bsd-3-clause")


def plain(texts):
    """For each text (n_words, n_base, first, last, base_labels, labels, score)."""
    cut = lambda t: re.findall(licenses.WORD, re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
    docs = [cut(t) for t in texts]
    templates = [(label, cut(t), [p.split() for p in ps]) for label, t, ps in licenses.TEMPLATES]
    vocabulary = {w for _, words, _ in templates for w in words}
    df = {w: sum(w in d for d in map(set, docs)) for w in vocabulary}
    out = []
    for words in docs:
        at = defaultdict(list)
        for i, w in enumerate(words):
            at[w].append(i)
        places = [
            (i, label) for p, label in licenses.BASE for i in at[p.split()[0]] if words[i : i + len(p.split())] == p.split()
        ]
        base = {label for _, label in places}
        best = {}
        for label, notice, phrases in templates:
            ranked = sorted(set(notice), key=lambda w: (df[w], w))
            rare = [w for w in ranked if w in at][: licenses.LOOKUPS]
            windows, spoken = defaultdict(set), defaultdict(set)
            cells = lambda shift: [(0, shift // 16), (1, (shift + 8) // 16)]
            for w in rare:
                for i in at[w]:
                    for j, x in enumerate(notice):
                        if x == w:
                            for c in cells(i - j):
                                windows[c].add(w)
            for n, p in enumerate(phrases):
                start = next(j for j in range(len(notice)) if notice[j : j + len(p)] == p)
                for i in at[p[0]]:
                    if words[i : i + len(p)] == p:
                        for c in cells(i - start):
                            spoken[c].add(n)
            for c in windows:
                share = len(windows[c]) / min(licenses.LOOKUPS, len(ranked))
                if share >= licenses.MIN_SHARE and len(spoken[c]) == len(phrases):
                    best[label] = max(share, best.get(label, 0))
        starts = [i for i, _ in places]
        score = 1.0 if places else max(best.values(), default=0.0)
        out.append((
            len(words), len(places), min(starts, default=None), max(starts, default=None),
            ",".join(sorted(base)), ",".join(sorted(base | set(best))), round(score, 9),
        ))
    return out


NAMES = ("n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score")


def _found(spark, rows):
    importable(spark)
    df = spark.createDataFrame([(*r, "en", 1, 2, "x", "y", 3, "z") for r in rows], DOCS).repartition(3)
    return [(r["doc_id"], *(round(r[n], 9) if n == "score" else r[n] for n in NAMES)) for r in licenses.scan_licenses(df).collect()]


def _rows():
    texts = [
        None, "", " \n\t", FILL,
        f"{FILL}. Released under the MIT License.",
        f"{FILL} MIT-license, Apache License and GNU  General\nPublic License; CC BY. cc by",
        f"{FILL}\n{MIT}\n{FILL}",
        " ".join([FILL] * 30 + [MIT.replace("copy, modify, merge", "copy, also modify, then merge")]),  # words added
        MIT.replace("without restriction", "with some restriction"),  # a key phrase is missing
        f"{BSD3} {FILL} {MIT.upper()}",
        "permission granted free of charge to any person is hereby deal in the software without restriction",
        "\n".join(text for _, text, _ in licenses.TEMPLATES),
        "Licensed under CC BY-NC 4.0. " + FILL,
        "cc", "mit", "license mit", "MİT license mıt license mit license",
        "x" * 100_000 + " apache license",
    ]
    return [(i, t) for i, t in enumerate(texts)]


def test_notices_against_a_plain_search(spark):
    rows = _rows()
    rows += [(None, rows[4][1]), (4, rows[4][1]), (4, MIT), (None, None)]
    expected = sorted(((i, *x) for (i, _), x in zip(rows, plain([t for _, t in rows]))), key=repr)
    assert sorted(_found(spark, rows), key=repr) == expected
    labels = {i: x[5] for i, x in enumerate(plain([t for _, t in rows]))}
    assert labels[6] == labels[7] == "mit" and labels[8] == labels[10] == "" and labels[9] == "bsd-3-clause,mit"
    assert set(labels[11].split(",")) == {x for x, _, _ in licenses.TEMPLATES} | {"apache", "gpl", "cc-by"}


def test_without_small_data_plans(spark, no_small_data_plans):
    rows = _rows()
    expected = sorted(((i, *x) for (i, _), x in zip(rows, plain([t for _, t in rows]))), key=repr)
    assert sorted(_found(spark, rows), key=repr) == expected


def test_no_documents(spark):
    assert _found(spark, []) == []


def test_a_very_long_text(spark):
    # 20 MB, with a notice in the middle and at the end.
    part = (FILL + "\n") * 170_000
    found = _found(spark, [(1, f"{part}{MIT}\n{part}Apache License")])[0]
    n = 170_000 * len(FILL.split())
    assert found == (1, 2 * n + len(licenses.plain_words(MIT)) + 2, 1, found[3], found[3], "apache", "apache,mit", 1.0)
    assert found[3] == found[1] - 2


def test_rarities_are_of_all_documents(spark):
    importable(spark)
    rows = _rows()
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    rarity = licenses.rarities(licenses.noted(df))
    words = [set(licenses.plain_words(t or "")) for _, t in rows]
    for w in ("mit", "the", "mozilla"):
        assert math.isclose(rarity[w], math.log((1 + len(rows)) / (1 + sum(w in x for x in words))))


def test_no_python_on_documents(spark):
    importable(spark)
    df = spark.createDataFrame(_rows(), "doc_id bigint, text string")
    from weftgraph.llm.common import stage

    plan = licenses.scan_licenses(stage(df, "license-docs"))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan
