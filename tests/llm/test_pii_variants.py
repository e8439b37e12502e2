"""Forms that the patterns miss, planted in clean prose and found by a network fitted on the table."""

import random

import pytest

from weftgraph.llm import pii
from weftgraph.llm.common import table

SF = "/root/testdata/sf0.1"
NUMBER = random.Random(5)
PER_FORM = 60


def _digits(n):
    return "".join(NUMBER.choice("0123456789") for _ in range(n))


def _card():
    while True:
        digits = "4" + _digits(15)
        if pii._luhn(digits):
            return [digits[i : i + 4] for i in range(0, 16, 4)]


def _ip():
    return [str(NUMBER.randint(1, 255)) for _ in range(4)]


FORMS = {
    "email spelled": (0, lambda a, b, c: f"{a} at {b} dot org"),
    "email in brackets": (0, lambda a, b, c: f"{a}.{b} [at] {c} [dot] com"),
    "email in parentheses": (0, lambda a, b, c: f"{a}{NUMBER.randint(1, 99)}(at){b}.net"),
    "email with spaces": (0, lambda a, b, c: f"{a} @ {b}.com"),
    "ip with commas": (1, lambda *_: ",".join(_ip())),
    "ip with brackets": (1, lambda *_: "[.]".join(_ip())),
    "ip with hyphens": (1, lambda *_: "-".join(_ip())),
    "card with dots": (2, lambda *_: ".".join(_card())),
    "card with slashes": (2, lambda *_: "/".join(_card())),
    "phone without plus": (3, lambda *_: f"1 ({_digits(3)}) {_digits(3)}-{_digits(4)}"),
    "phone with dots": (3, lambda *_: f"7{_digits(2)}.{_digits(3)}.{_digits(4)}"),
    "secret": (4, lambda *_: "a1" + "".join(NUMBER.choice("0123456789abcdef") for _ in range(38))),
}


@pytest.fixture(scope="module")
def weights(spark):
    return pii.fit(table(spark, SF, "documents"))


def test_planted_variants_are_found(spark, weights):
    rows = table(spark, SF, "documents").where("length(text) > 300").orderBy("doc_id").collect()
    clean = [r["text"] for r in rows if not pii._TRIGGER.search(r["text"][:300])][:PER_FORM]
    planted, wanted = [], {}
    for name, (kind, form) in FORMS.items():
        for text in clean:
            words = text[:300].split(" ")
            place = NUMBER.randint(3, max(4, len(words) - 3))
            plain = [w for w in "".join(c.lower() if c.isascii() and c.isalpha() else " " for c in text).split() if len(w) > 2]
            found = form(*NUMBER.sample(plain, 3))
            before = " ".join(words[:place]) + (' api_key = "' if kind == 4 else " ")
            after = ('" ' if kind == 4 else " ") + " ".join(words[place:])
            doc = len(planted)
            planted.append((doc, before + found + after))
            wanted[doc] = (name, f"{pii.KINDS[kind] if kind < 4 else 'secret'}:{len(before)}:{len(before) + len(found)}")
    for doc, text in enumerate(clean, len(planted)):
        planted.append((doc, text[:300]))

    out = pii.find_personal_data(spark.createDataFrame(planted, "doc_id bigint, text string"), weights)
    spans = {r["doc_id"]: [x for x in r["spans"].split(",") if x] for r in out.collect()}
    for name in FORMS:
        docs = [d for d, (n, _) in wanted.items() if n == name]
        assert sum(wanted[d][1] in spans[d] for d in docs) >= 0.9 * len(docs), name
    right = sum(wanted[d][1] in spans[d] for d in wanted)
    assert right >= 0.9 * sum(map(len, spans.values()))
    # Prose of its own has none.
    assert sum(map(bool, (spans[d] for d in spans if d not in wanted))) <= 0.02 * len(clean)


def _dense():
    """A list of 120 numbers without their plus sign, one every 31 characters, and their places."""
    places, text = set(), ""
    for i in range(120):
        text += f"no {i} call "
        phone = f"1 ({200 + i}) 555-{1000 + i}"
        places.add((3, len(text), len(text) + len(phone)))
        text += phone + " now "
    return text, places


def test_pieces_of_a_long_stretch_share_it(weights, monkeypatch):
    """Where windows lie differs, so decoded ends may; each span still counts in one piece alone."""
    text, places = _dense()
    monkeypatch.setattr(pii, "PIECE", 700)
    monkeypatch.setattr(pii, "AT_ONCE", 2000)
    own = [(low, high) for _, _, low, high in pii._pieces(5, len(text))]
    assert own[0][0] == 5 and own[-1][1] == len(text)
    assert all(x[1] == y[0] for x, y in zip(own, own[1:]))
    found = pii.added_spans(text, pii.decoded_spans(pii.Tagger(weights), [text])[0], [])
    assert places & set(found)
    assert len(set(found)) == len(found) and all(x[2] <= y[1] for x, y in zip(found, found[1:]))


@pytest.mark.xfail(reason="open: 74 of 120 were found when measured; the network learns from texts with few numbers")
def test_dense_lists_of_numbers(weights):
    text, places = _dense()
    found = pii.added_spans(text, pii.decoded_spans(pii.Tagger(weights), [text])[0], [])
    assert len(places & set(found)) >= 0.9 * len(places)


def test_long_and_odd_texts(weights):
    model = pii.Tagger(weights)
    for text in ("9" * 300_000, "@" * 200_000, "at " * 100_000, "(at) dot " * 20_000, "[" + " " * 200_000, "1." * 100_000):
        found = pii.added_spans(text, pii.decoded_spans(model, [text])[0], pii.base_spans(text))
        assert all(0 <= a < b <= len(text) for _, a, b in found)


def test_tests_of_the_kinds():
    assert pii._plausible(0, "joe at site dot org") and pii._plausible(0, "joe[at]site[dot]org")
    assert not pii._plausible(0, "at home") and not pii._plausible(0, "joe at site")
    assert pii._plausible(1, "10,1,2,3") and not pii._plausible(1, "10,1.2,3") and not pii._plausible(1, "300-1-2-3")
    assert pii._plausible(2, "4111.1111.1111.1111") and not pii._plausible(2, "4111.1111.1111.1112")
    assert pii._plausible(3, "743.555.3824") and not pii._plausible(3, "743 and 5553824")
    assert pii._plausible(4, "24be64439e3e49cf46b2") and not pii._plausible(4, "24be64439e3e 49cf46b2")
    # A part of a number is not taken for a number.
    text = "pay 4111.1111.1111.1111 now"
    assert pii.added_spans(text, [(3, 5, 23)], []) == [(2, 4, 23)]
