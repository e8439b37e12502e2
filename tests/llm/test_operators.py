"""The operators against plain versions, on a test table and on odd rows."""

from __future__ import annotations

import hashlib
import zlib
from collections import defaultdict

import duckdb
import numpy as np
import pytest
from tests.llm import plain
from weftgraph.llm import jaccard, language, lines, mixing, packing, pii, quality, substrings, topk, warc
from weftgraph.llm.common import importable
from weftgraph.llm.queries import QUERIES, SQL

SF_DIR = "/root/testdata/sf0.001"
DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint, size int, _at int, spans string"

LONG = " ".join(f"word{i % 977}" for i in range(30_000))
PROSE = "the quick brown fox jumps over the lazy dog and runs through the green wood until the cold night comes down again"
ODD = [
    (1, None, None, None, None),
    (2, "", "en", "a", 0),
    (3, " \t\n\x0b ", "en", None, 3),
    (4, LONG, "en", "a", len(LONG)),
    (5, LONG + " tail", "en", "b", 1),
    (6, PROSE, "en", "b", 1),
    (7, PROSE, "en", "b", 1),
    (7, PROSE, "en", "b", 1),
    (8, PROSE.upper() + "\n" + PROSE, None, "é", 1),
    (9, "x@y.z 10.1.2.3 +1 (389) 555-5010 4111 1111 1111 1111", "de", "z", 1),
    (10, "\n".join([PROSE, "short", PROSE]), "en", "b", 1),
    (None, PROSE + " end", "en", "b", None),
]


@pytest.fixture(scope="module")
def docs(spark):
    importable(spark)
    return spark.createDataFrame([(*r, 9, 9, "x") for r in ODD], DOCS).repartition(3)


@pytest.fixture(scope="module")
def none(spark, docs):
    return docs.where("false")


@pytest.fixture(scope="module")
def table_rows():
    return duckdb.sql(f"SELECT doc_id, text, source FROM read_parquet('{SF_DIR}/documents.parquet')").fetchall()


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "pages", "embeddings", "conversations"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_DIR}/{t}.parquet')")
    found = con.execute(SQL[name])
    names = [c[0] for c in found.description]
    ours = QUERIES[name](spark, SF_DIR)
    assert sorted(ours.columns) == sorted(names)
    assert sorted(map(repr, (tuple(r[c] for c in names) for r in ours.collect()))) == sorted(map(repr, found.fetchall()))


# -- 1 ---------------------------------------------------------------------------------


def test_languages_of_held_out_documents(spark):
    rows = QUERIES["op1_language"](spark, SF_DIR).collect()
    told = dict(duckdb.sql(f"SELECT doc_id, lang FROM read_parquet('{SF_DIR}/documents.parquet')").fetchall())
    held = [r for r in rows if r["held_out"]]
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) for r in rows)
    assert sum(r["lang_pred"] == told[r["doc_id"]] for r in held) >= 0.95 * len(held)
    assert all(0 <= r["score"] <= 1 for r in rows)


def test_language_of_odd_rows(docs, none):
    learned = language.learn(docs.where("doc_id in (4, 6)"))
    rows = {r["doc_id"]: r for r in language.predict(docs, learned).collect()}
    assert {rows[i]["lang_pred"] for i in (1, 2, 3)} == {"und"}
    assert rows[4]["lang_pred"] == rows[6]["lang_pred"] == "en"
    assert language.predict(none, learned).count() == 0
    assert {r["lang_pred"] for r in language.predict(docs, language.learn(none)).collect()} == {"und"}


# -- 2 ---------------------------------------------------------------------------------


def _check_mix(rows, source_of):
    sizes, taken, target = defaultdict(int), defaultdict(int), {}
    for r in rows:
        s = source_of[r["doc_id"]]
        sizes[s] += r["size"]
        taken[s] += r["taken"]
        target[s] = r["target"]
        assert 0 <= r["taken"] <= 2 * r["size"]
    expected = plain.mixing_targets(sizes)
    for s in sizes:
        assert target[s] == pytest.approx(expected[s])
        assert abs(taken[s] - target[s]) <= 1


def test_mix_reaches_its_targets(spark, table_rows):
    rows = QUERIES["op2_mixing"](spark, SF_DIR).collect()
    assert {r["doc_id"]: r["size"] for r in rows} == {i: len(plain.words(t)) for i, t, _ in table_rows}
    _check_mix(rows, {i: s for i, _, s in table_rows})
    assert sorted(map(repr, QUERIES["op2_mixing"](spark, SF_DIR).collect())) == sorted(map(repr, rows))


def test_mix_of_odd_rows(docs, none):
    rows = mixing.mix(docs, block_words=64).collect()
    assert len(rows) == len(ODD)
    _check_mix(rows, {r[0]: r[3] for r in ODD})
    assert mixing.mix(none).count() == 0
    mixed = mixing.mix_documents(docs)
    assert mixed.columns == docs.columns and 1 not in {r["doc_id"] for r in mixed.collect()}


# -- 3 ---------------------------------------------------------------------------------


def test_lines_of_odd_rows(docs, none):
    rows = lines.dedup_lines(docs).collect()
    once = [(r[0] if r[0] is not None else -(2**63), r[1]) for r in ODD]
    expected = plain.dedup_lines(once)
    assert len(rows) == len(ODD)
    for r in rows:
        key = r["doc_id"] if r["doc_id"] is not None else -(2**63)
        assert (r["n_lines"], r["n_dropped"], r["kept_text"]) == expected[key]
    assert lines.dedup_lines(none).count() == 0


# -- 4 ---------------------------------------------------------------------------------


def test_base_statistics(spark, table_rows):
    rows = QUERIES["op4_quality"](spark, SF_DIR).collect()
    text = {i: t for i, t, _ in table_rows}
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")
    for r in rows:
        assert tuple(r[c] for c in names) == plain.base_statistics(text[r["doc_id"]])
        assert not (r["base_failed"] and r["kept"])


def test_outliers_and_odd_rows(spark, docs, none):
    rows = quality.judge(docs).collect()
    assert len(rows) == len(ODD)
    assert {r["doc_id"]: r["kept"] for r in rows if r["doc_id"] in (1, 2, 3, 6, 7)} == {1: False, 2: False, 3: False, 6: True, 7: True}
    assert quality.judge(none).count() == 0
    rng = np.random.default_rng(0)
    prose = [(i, " ".join(f"w{x}" for x in rng.integers(0, 5000, 60 + i % 40)), "en", "a") for i in range(200)]
    odd = [(1000, " ".join("#$%&*" * 4 + f"{x}" for x in range(80)), "en", "a")]
    judged = quality.judge(spark.createDataFrame(prose + odd, "doc_id bigint, text string, lang string, source string")).collect()
    assert [r["doc_id"] for r in judged if not r["kept"]] == [1000]


def test_moderate_outliers_go_and_clean_documents_stay(spark):
    rng = np.random.default_rng(5)

    def prose(count, letters=(2, 9)):
        return ["".join(rng.choice(list("etaoinshr"), rng.integers(*letters))) for _ in range(count)]

    def in_lines(words):
        return "\n".join(" ".join(words[i : i + 7]) for i in range(0, len(words), 7))

    rows = [(i, in_lines(prose(int(np.exp(rng.normal(5, 0.5))) + 20))) for i in range(400)]
    block, other = " ".join(prose(12)), in_lines(prose(70)).split("\n")
    # A quarter of the words repeated, 8 of 20 lines duplicates.
    repeated = "\n".join([block, *[x for line in other[:8] for x in (line, "note")], *other[8:], block])
    assert plain.base_statistics(repeated)[2:] == (0, 8, 24, False)
    symbols = in_lines([w + "|" * (i % 2) for i, w in enumerate(prose(150))])
    rows += [(1000, repeated), (1001, symbols), (1002, in_lines(prose(150, (6, 11))))]
    df = spark.createDataFrame([(*r, "en", "a") for r in rows], "doc_id bigint, text string, lang string, source string")
    kept = {r["doc_id"] for r in quality.judge(df.repartition(3)).collect() if r["kept"]}
    assert not kept & {1000, 1001, 1002}
    assert len(kept) >= 0.99 * 400


# -- 5 ---------------------------------------------------------------------------------


def test_archives_give_the_pages_back(spark):
    html = "<p>" + "á" * 100
    pages = [(1, "http://A.b.org/x?y", html), (2, "http://a.b.org/x", html), (2, "http://a.b.org/x", html), (3, None, None),
             (4, "nonsense", "tiny"), (5, "https://u@h.com:80/", "tiny"), (None, "http://a.b.org/x", html + "!"), (7, "http://z/", "q" * 50_000)]
    df = spark.createDataFrame([(*p, 1) for p in pages], "page_id bigint, url string, html string, payload int").drop("payload").repartition(3)
    rows = sorted(warc.archive(df).collect(), key=lambda r: (r["page_id"] is not None, r["page_id"] or 0))
    kinds = [(r["page_id"], r["record_type"], r["refers_to"]) for r in rows]
    assert kinds == [(None, "response", None), (1, "response", None), (2, "revisit", 1), (2, "revisit", 1), (3, "response", None),
                     (4, "response", None), (5, "response", None), (7, "response", None)]
    text = {p[0]: p[2] or "" for p in pages}
    for r in rows:
        payload = text[r["page_id"]].encode()
        assert r["payload_bytes"] == len(payload) and r["payload_digest"] == hashlib.sha256(payload).hexdigest()
        assert r["payload"] == (payload if r["record_type"] == "response" else None)
    assert warc.archive(df.where("false")).count() == 0


def test_reversed_host(spark):
    urls = [("http://WWW.a.org:80/x?y",), ("https://u@h.com/",), ("odd",), (None,)]
    rows = spark.createDataFrame(urls, "url string").select(warc.reversed_host_key("url")).collect()
    assert [r[0] for r in rows] == ["org,a,www):80/x?y", "com,h)/", "odd", ""]


# -- 6 ---------------------------------------------------------------------------------


def test_substrings_of_odd_rows(docs, none):
    plain_rows = [(r[0], r[1]) for r in ODD if r[0] is not None]
    expected = plain.dedup_substrings(list(dict(plain_rows).items()))
    # Small bins: every prefix length and the split by whole windows are used.
    rows = substrings.dedup_substrings(docs.where("doc_id is not null"), bin_suffixes=64).collect()
    assert len(rows) == len(plain_rows)
    for r in rows:
        assert (r["n_words"], r["n_removed"], r["kept_sha256"]) == expected[r["doc_id"]]
    assert substrings.dedup_substrings(none).count() == 0
    first = [r for r in substrings.dedup_substrings(docs).collect() if r["doc_id"] is None]
    assert [r["n_removed"] for r in first] == [0]


# -- 7 ---------------------------------------------------------------------------------


def _check_components(rows, texts):
    expected = plain.jaccard_components(texts)
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in rows} == expected


def test_components_of_the_table(spark, table_rows):
    _check_components(QUERIES["op7_jaccard"](spark, SF_DIR).collect(), [(i, t) for i, t, _ in table_rows])


def test_components_of_near_copies_and_odd_rows(spark, docs, none, monkeypatch):
    rng = np.random.default_rng(4)
    base = [f"w{i}" for i in range(120)]
    texts = [(i, t) for i, t, *_ in ODD[:7]]
    for i in range(100, 260):
        words = list(base)
        for place in rng.integers(0, len(words), rng.integers(0, 6)):
            words[place] = f"e{i}x{place}"
        texts.append((i, " ".join(words)))
    monkeypatch.setattr(jaccard, "HELD_PAIRS", 500)
    monkeypatch.setattr(jaccard, "CELL_DOCS", 40)
    df = spark.createDataFrame(texts, "doc_id bigint, text string").repartition(4)
    _check_components(jaccard.join_components(df).collect(), texts)
    assert jaccard.join_components(none).count() == 0
    assert jaccard.join_components(docs).count() == len(ODD)


# -- 8 ---------------------------------------------------------------------------------


def test_base_spans_equal_the_patterns():
    rng = np.random.default_rng(1)
    parts = ["@", "a.b", "x@y.z", "+", "1", "23.4.5.6", " ", "-", "(", "4111 1111 1111 1111", "..", "+1 (389) 555-5010", "é", "\n", "256.1.1.1.1"]
    for _ in range(3000):
        text = "".join(rng.choice(parts, rng.integers(1, 12)))
        ours = [(pii.KINDS[k], a, b) for k, a, b in pii.base_spans(text)]
        assert ours == plain.base_spans(text), text


def test_personal_data_of_odd_rows(spark, docs, none):
    weights = pii.fit(docs)
    rows = {r["doc_id"]: r for r in pii.find_personal_data(docs, weights).collect()}
    base = plain.base_spans(ODD[9][1])
    listed = ",".join(f"{k}:{a}:{b}" for k, a, b in base)
    assert rows[9]["base_sha256"] == hashlib.sha256(listed.encode()).hexdigest()
    assert set(listed.split(",")) <= set(rows[9]["spans"].split(","))
    assert rows[1]["spans"] == "" and rows[4]["n_card"] == 0
    assert pii.find_personal_data(none).count() == 0


def test_the_gradient_is_that_of_the_likelihood():
    rng = np.random.default_rng(2)
    codes, tags = rng.integers(1, pii.CHARS, (3, 7)), rng.integers(0, pii.TAGS, (3, 7))
    codes[1, 5:], tags[1, 5:] = 0, 0
    model = pii.Tagger()
    model.w = {k: v.astype(np.float64) for k, v in model.w.items()}

    def loss():
        scores, step = model.scores(codes), model.w["step"]
        total = 0.0
        for b in range(3):
            n = int((codes[b] > 0).sum())
            forward = scores[0, b]
            path = scores[0, b, tags[b, 0]]
            for t in range(1, n):
                forward = pii._log_sum(forward[:, None] + step, 0) + scores[t, b]
                path += step[tags[b, t - 1], tags[b, t]] + scores[t, b, tags[b, t]]
            total += pii._log_sum(forward, 0) - path
        return total / 3

    grad = model.learn_from(codes, tags)
    for name in ("out", "step", "fx", "bh", "embed"):
        place = np.unravel_index(np.abs(grad[name]).argmax(), grad[name].shape)
        model.w[name][place] += 1e-3
        up = loss()
        model.w[name][place] -= 2e-3
        down = loss()
        model.w[name][place] += 1e-3
        assert (up - down) / 2e-3 == pytest.approx(grad[name][place], rel=0.05, abs=1e-3)


def test_the_model_finds_what_the_patterns_miss():
    rng = np.random.default_rng(5)
    number = lambda: f"({rng.integers(100, 999)}) {rng.integers(100, 999)}-{rng.integers(1000, 9999)}"
    made = []
    for _ in range(400):
        word = " ".join(rng.choice(["the", "and", "call", "house"], 3))
        text = f"{word} +1 {number()} {word}" if rng.random() < 0.5 else f"{word} 1 {number()} {word}"
        start = text.index("1 (")
        made.append((text, [(3, start - (text[start - 1] == "+"), text.rindex(word) - 1)]))
    codes, tags = np.zeros((400, pii.WINDOW), np.int64), np.zeros((400, pii.WINDOW), np.int64)
    for i, (text, spans) in enumerate(made):
        n = min(len(text), pii.WINDOW)
        codes[i, :n], tags[i, :n] = pii._codes(text)[:n], pii._tags(len(text), spans, 0)[:n]
    model = pii.train(codes, tags)
    text = "the house and 1 (389) 555-5010 call"
    found = pii._spans_of(pii.decode(model, [text])[0], 0)
    assert pii.added_spans(text, found, pii.base_spans(text)) == [(3, 14, 30)]


def test_repeats_of_rows_that_share_an_id(spark):
    text = lambda x: " ".join(f"{x}{i}" for i in range(40))
    rows = [(1, text("a")), (2, text("a")), (2, text("b")), (None, text("c")), (None, text("d")), (None, text("c")), (3, text("d")), (2, None)]
    df = spark.createDataFrame([(*r, "en", "a", 9, 9, 9, "x") for r in rows], DOCS).repartition(3)
    importable(spark)
    for bins in (1 << 20, 16):
        found = [(r["doc_id"], r["kept_text"][:2], r["n_removed"]) for r in substrings.dedup_substrings(df, bin_suffixes=bins).collect()]
        assert sorted(found, key=repr) == sorted(
            [(1, "a0", 0), (2, "", 40), (2, "b0", 0), (None, "c0", 0), (None, "c0", 0), (None, "d0", 0), (3, "", 40), (2, "", 0)], key=repr
        )


def test_columns_that_have_the_names_used_inside(spark):
    names = "_id _text _places _lines _stretches _key _same _times _time _size _taken size a b row kept text_".split()
    fields = ", ".join(f"{n} string" for n in names)
    rows = [(i, PROSE if i < 4 else f"{PROSE}\n{i}", "en", "a", 5, *(f"{n}{i}" for n in names)) for i in range(6)]
    df = spark.createDataFrame(rows, f"doc_id bigint, text string, lang string, source string, n_chars bigint, {fields}")
    importable(spark)
    for found in (lines.dedup_lines(df), mixing.mix_documents(df)):
        assert found.columns[: len(df.columns)] == df.columns
        assert all(r[n] == f"{n}{r['doc_id']}" for r in found.collect() for n in names)


# -- 9 ---------------------------------------------------------------------------------


def test_top_k_with_ties_and_odd_vectors(spark):
    rng = np.random.default_rng(3)
    good = [(i, [float(x) for x in np.round(rng.standard_normal(6), 1)]) for i in range(300)]
    good += [(i, good[50][1]) for i in range(300, 340)]
    odd = [(1000, None), (1001, []), (1002, [1.0, None]), (1003, [float("nan")]), (1004, [float("inf")])]
    df = spark.createDataFrame([(*r, 1) for r in good + odd], "vec_id bigint, embedding array<double>, score int")
    importable(spark)
    rows = topk.top_k(df, df.where("vec_id % 50 = 0"), 5).collect()
    whole = [(i, [int(np.floor(256 * x)) for x in v]) for i, v in good]
    assert sorted(tuple(r) for r in rows) == sorted(plain.top_k(whole))
    assert topk.top_k(df.where("false"), df.where("false"), 5).count() == 0
    assert topk.top_k(df.where("vec_id = 50"), df.where("vec_id = 50"), 5).count() == 0


# -- 10 --------------------------------------------------------------------------------


def _check_packing(rows, texts):
    import public_tokenizers
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    encoded = tokenizer.encode_batch([t or "" for _, t in texts], add_special_tokens=False)
    ids = {i: [*e.ids, 2] for (i, _), e in zip(texts, encoded)}
    pieces, bins = defaultdict(list), defaultdict(list)
    for r in rows:
        part = np.array(ids[r["doc_id"]][r["start"] : r["start"] + r["length"]], "<u4")
        assert zlib.crc32(part.tobytes()) == r["ids_crc32"]
        pieces[r["doc_id"]].append((r["piece"], r["start"], r["length"]))
        bins[r["sequence_id"]].append((r["offset"], r["length"]))
    for i, found in pieces.items():
        found = sorted(set(found))
        assert [p for p, _, _ in found] == list(range(len(found)))
        assert sum(n for _, _, n in found) == len(ids[i])
        assert all(n == 1024 for p, _, n in found if p)
    for found in bins.values():
        at = 0
        for offset, n in sorted(found):
            assert offset == at
            at += n
        assert at <= 1024
    return len(bins), sum(len(x) for x in ids.values())


def test_packing_of_the_table(spark, table_rows):
    bins, tokens = _check_packing(QUERIES["op10_packing"](spark, SF_DIR).collect(), [(i, t) for i, t, _ in table_rows])
    assert bins <= tokens / 1024 * 1.02 + 1


def test_packing_of_odd_rows(docs, none):
    rows = packing.pack(docs).collect()
    _check_packing(rows, [(r[0], r[1]) for r in ODD])
    assert {r["length"] for r in rows if r["doc_id"] in (1, 2)} == {1}
    assert packing.pack(none).count() == 0


def test_ids_are_those_of_tokenizers():
    import public_tokenizers
    from tokenizers import Tokenizer

    path = public_tokenizers.path("byte_bpe_50k.json")
    slow, fast = Tokenizer.from_file(path), packing._encoder(path)
    end = "<|endoftext|>"
    texts = [f"a {end} b", end, f"{end}{end}", f"x{end}", f"{end}x", f"{end} é {end}\n\n ", end.upper(), end[:-1], f"<|endof{end}text|>"]
    for space in " \n\t\u3000":
        texts += [f"a{space * n}b" for n in (1999, 2000, 10**6)]
    texts += ["a" * 10**6, "1" * 10**6]
    rng = np.random.default_rng(10)
    parts = ["a", "the ", " ", "\n", "\t", "é", "中", "😀", "22", "'ll", "!", "<|", "|>", "endoftext", end, "\xa0", "\x00", "İ"]
    texts += ["".join(rng.choice(parts, rng.integers(0, 40))) for _ in range(10_000)]
    assert all(fast(t) == slow.encode(t, add_special_tokens=False).ids for t in texts)


def test_packing_of_copies_and_odd_tokens(spark):
    rows = [(1, PROSE)] * 300 + [(None, PROSE)] * 100 + [(2, "a <|endoftext|> b"), (3, "a" + " " * 10**6 + "b")]
    df = spark.createDataFrame([(*r, "en", "a", 9, 9, 9, "x") for r in rows], DOCS).repartition(4)
    importable(spark)
    found = packing.pack(df).collect()
    _check_packing(found, [(i, t) for i, t in {(i, t): None for i, t in rows}])
    assert sum(r["doc_id"] == 1 for r in found) == 300


@pytest.mark.parametrize("seed", range(6))
def test_plans_hold_every_piece(seed):
    rng = np.random.default_rng(seed)
    counts = {int(n): int(rng.integers(1, 50)) for n in rng.integers(1, 1024, 80)}
    runs = packing.plan(counts)
    packed = defaultdict(int)
    for run in runs:
        assert sum(run.items) + run.room == 1024 and run.room >= 0 and run.count > 0
        assert sum(3 * n > 1024 for n in run.items) <= 2
        for n in run.items:
            packed[n] += run.count
    assert packed == counts
