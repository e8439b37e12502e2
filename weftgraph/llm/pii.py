"""Personal data: patterns, and a character-level BiLSTM with a CRF.

The patterns give the base spans.  A bidirectional LSTM with conditional-random-field
transitions is trained in numpy from windows labelled with these spans and with those of
secrets (tokens and passwords that a text assigns), all of them also rewritten to forms
that the patterns miss: spelled-out at signs and dots, other separators, phone numbers
without their plus sign.  Text around digits, at signs and spelled-out ones, which every
such form has, is cut into overlapping windows; the scores of the windows that share a
character are averaged, nearer to a window's middle weighing more, and one best path is
decoded through the whole stretch.  Its spans are widened to whole words and added if
they overlap no base span and, brought to the plain form of their kind, pass its test.

The model is fitted on at most ``TRAIN_WINDOWS`` windows, taken from all documents by
a hash; counts, patterns and decoding cover every text.  Null and empty texts have no
spans.  Rows are judged one by one.
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_left
from collections.abc import Callable, Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weftgraph.llm.common import slices

KINDS = ("email", "ip", "card", "phone")
#: Kinds that only the network adds; they come after the others.
ADDED_KINDS = ("secret",)
ALL_KINDS = KINDS + ADDED_KINDS
#: The domain of an e-mail address and the other patterns.
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![0-9])[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
_CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_LOCAL_CHARS = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_AT = r"\s{0,3}(?:@|[\[({]\s?(?:at|@)\s?[\])}]|(?<=\s)at(?=\s))\s{0,3}"
_DOT = r"\s{0,3}(?:[\[({]\s?(?:dot|\.)\s?[\])}]|(?<=\s)dot(?=\s))\s{0,3}|\.|\s\.\s"
_SPELLED_DOMAIN = re.compile(rf"[A-Za-z0-9-]+(?:(?:{_DOT})[A-Za-z0-9-]+)*?(?:{_DOT})[A-Za-z]{{2,24}}(?![A-Za-z0-9])(?!(?:{_DOT})[A-Za-z0-9])", re.I)
_SPELLED_AT, _SPELLED_DOT = re.compile(_AT, re.I), re.compile(_DOT, re.I)
_TRIGGER = re.compile(
    r"[0-9@]+|[\[({]\s{0,3}(?:at|dot)\s{0,3}[\])}]|(?<![A-Za-z0-9])dot(?![A-Za-z0-9])"
    r"|(?<![A-Za-z0-9])at\s{1,3}[A-Za-z0-9-]{1,64}\.[A-Za-z]", re.I)
_SEPARATOR = re.compile(r"[^0-9]+")
#: What a text assigns to a name that says it is secret; the labels of that kind.
_SECRET = re.compile(r"(?:token|key|secret|password|passwd|pwd)[\"']?\s{0,3}[=:]\s{0,3}[\"']?([A-Za-z0-9_+/=-]{16,128})", re.I)

WINDOW, STRIDE, MARGIN = 64, 32, 24
TRAIN_WINDOWS, TRAIN_STEPS, TRAIN_BATCH = 8000, 600, 96
EMBED, HIDDEN = 12, 24
TAGS = 1 + 2 * len(ALL_KINDS)
CHARS = 98
#: Rewritten versions of each text with labels that the network learns from.
VERSIONS = 4
_WORDS = re.compile(r"[A-Za-z]{2,12}")
BATCH_BYTES, BATCH_WINDOWS = 4 << 20, 1024
#: Longer stretches are decoded in pieces that reach over one another; a span counts in
#: the piece in whose own part it starts.  Pieces of so many characters are decoded at once.
PIECE, REACH, AT_ONCE = 8192, 160, 1 << 18
#: Most characters by which a span is widened to whole words.
WIDEN = 64

Span = tuple[int, int, int]


# -- base ---------------------------------------------------------------------------


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost matches, in one pass: an at sign with its local part and domain."""
    end, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > end and text[start - 1] in _LOCAL_CHARS:
            start -= 1
        domain = _DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            yield start, domain.end()
        end = max(end, domain.end() if domain else at + 1)
        at = text.find("@", end)


def _luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = int(d) * (1 + i % 2)
        total += n - 9 if n > 9 else n
    return total % 10 == 0


def _only_digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def _is_ip(text: str) -> bool:
    parts = [p.lstrip("0") for p in text.split(".")]
    return len(parts) == 4 and all(len(p) <= 3 and int(p or 0) <= 255 for p in parts)


def _is_card(text: str) -> bool:
    digits = _only_digits(text) if len(text) <= 64 else ""
    return 13 <= len(digits) <= 19 and _luhn(digits)


def _is_phone(text: str) -> bool:
    return 9 <= sum("0" <= c <= "9" for c in text) <= 15


def base_spans(text: str) -> list[Span]:
    """(kind, start, end) by kind, then start."""
    if not _TRIGGER.search(text):
        return []
    out = [(0, a, b) for a, b in _emails(text)]
    for kind, pattern, test in ((1, _IP, _is_ip), (2, _CARD, _is_card), (3, _PHONE, _is_phone)):
        out += [(kind, m.start(), m.end()) for m in pattern.finditer(text) if test(m.group())]
    return out


def listed(spans: list[Span]) -> str:
    return ",".join(f"{ALL_KINDS[k]}:{a}:{b}" for k, a, b in sorted(spans))


# -- windows ------------------------------------------------------------------------


def stretches(text: str) -> list[tuple[int, int]]:
    """Text within ``MARGIN`` of a digit, an at sign or a spelled-out one, as ranges that do not touch."""
    out: list[tuple[int, int]] = []
    for m in _TRIGGER.finditer(text):
        a, b = max(0, m.start() - MARGIN), min(len(text), m.end() + MARGIN)
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], b)
        else:
            out.append((a, b))
    return out


def _pieces(a: int, b: int) -> Iterator[tuple[int, int, int, int]]:
    """Pieces of a stretch: what is decoded, and the part of it that is the piece's own."""
    for low in range(a, b, PIECE):
        high = min(b, low + PIECE)
        yield max(a, low - REACH), min(b, high + REACH), low, high


def _cuts(length: int) -> list[int]:
    """Starts of windows that cover the length, with overlap."""
    if length <= WINDOW:
        return [0]
    return [*range(0, length - WINDOW, STRIDE), length - WINDOW]


def _codes(text: str) -> np.ndarray:
    """ASCII as itself, all else alike; 0 is padding."""
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)
    return np.where((points >= 32) & (points < 127), points - 30, 1)


def _tags(length: int, spans: list[Span], start: int) -> np.ndarray:
    out = np.zeros(length, np.int64)
    for kind, a, b in spans:
        low, high = max(a - start, 0), min(b - start, length)
        if low < high:
            out[low:high] = 2 + 2 * kind
            if a >= start:
                out[low] = 1 + 2 * kind
    return out


# -- the network --------------------------------------------------------------------


class Tagger:
    """Embedding, an LSTM each way, scores per tag, and transitions between tags."""

    def __init__(self, weights: dict[str, np.ndarray] | None = None):
        rng = np.random.default_rng(3)
        make = lambda *shape: (rng.standard_normal(shape) * 0.3 / np.sqrt(shape[0])).astype(np.float32)
        self.w = weights or {
            "embed": make(CHARS, EMBED) * 3,
            "out": make(2 * HIDDEN, TAGS),
            "bias": np.zeros(TAGS, np.float32),
            "step": np.zeros((TAGS, TAGS), np.float32),
            **{f"{d}{n}": make(size, 4 * HIDDEN) for d in "fb" for n, size in (("x", EMBED), ("h", HIDDEN))},
            **{f"{d}b": np.repeat(np.float32([0, 1, 0, 0]), HIDDEN) for d in "fb"},
        }

    def _lstm(self, x: np.ndarray, live: np.ndarray, d: str, keep: list | None) -> np.ndarray:
        """Hidden states (time, batch, unit); ``live`` is 0 on padding."""
        time, batch, _ = x.shape
        pre = x @ self.w[d + "x"] + self.w[d + "b"]
        h = c = np.zeros((batch, HIDDEN), np.float32)
        out = np.zeros((time, batch, HIDDEN), np.float32)
        for t in range(time) if d == "f" else range(time - 1, -1, -1):
            z = pre[t] + h @ self.w[d + "h"]
            gates = 1 / (1 + np.exp(-z[:, : 3 * HIDDEN]))
            i, f, o = np.split(gates, 3, axis=1)
            g = np.tanh(z[:, 3 * HIDDEN :])
            new = f * c + i * g
            squashed = np.tanh(new)
            if keep is not None:
                keep.append((t, h, c, i, f, o, g, squashed))
            h, c = o * squashed * live[t], new * live[t]
            out[t] = h
        return out

    def scores(self, codes: np.ndarray, keep: dict | None = None) -> np.ndarray:
        """(time, batch, tag) of codes (batch, time)."""
        codes = codes.T
        live = (codes > 0).astype(np.float32)[:, :, None]
        x = self.w["embed"][codes]
        tapes = {"f": [], "b": []} if keep is not None else {"f": None, "b": None}
        h = np.concatenate([self._lstm(x, live, d, tapes[d]) for d in "fb"], axis=2)
        if keep is not None:
            keep.update(x=x, codes=codes, live=live, h=h, tapes=tapes)
        return h @ self.w["out"] + self.w["bias"]

    def learn_from(self, codes: np.ndarray, tags: np.ndarray) -> dict[str, np.ndarray]:
        """Gradient of the mean negative log-likelihood."""
        keep: dict = {}
        scores = self.scores(codes, keep)
        d_scores, d_step = _crf_gradient(scores, self.w["step"], tags.T, keep["live"][:, :, 0])
        n = np.float32(len(codes))
        d_scores, grad = d_scores / n, {"step": d_step / n}
        h = keep["h"]
        flat = h.reshape(-1, 2 * HIDDEN)
        grad["out"] = flat.T @ d_scores.reshape(-1, TAGS)
        grad["bias"] = d_scores.sum(axis=(0, 1))
        d_h = d_scores @ self.w["out"].T
        d_x = np.zeros_like(keep["x"])
        for d, part in (("f", d_h[:, :, :HIDDEN]), ("b", d_h[:, :, HIDDEN:])):
            d_pre = np.zeros((*part.shape[:2], 4 * HIDDEN), np.float32)
            grad[d + "h"] = np.zeros_like(self.w[d + "h"])
            back_h = back_c = np.zeros(part.shape[1:], np.float32)
            for t, h0, c0, i, f, o, g, squashed in reversed(keep["tapes"][d]):
                live = keep["live"][t]
                dh, dc = (part[t] + back_h) * live, back_c * live
                dc = dc + dh * o * (1 - squashed**2)
                dz = np.concatenate([dc * g * i * (1 - i), dc * c0 * f * (1 - f),
                                     dh * squashed * o * (1 - o), dc * i * (1 - g**2)], axis=1)
                d_pre[t] = dz
                grad[d + "h"] += h0.T @ dz
                back_h, back_c = dz @ self.w[d + "h"].T, dc * f
            grad[d + "x"] = keep["x"].reshape(-1, EMBED).T @ d_pre.reshape(-1, 4 * HIDDEN)
            grad[d + "b"] = d_pre.sum(axis=(0, 1))
            d_x += d_pre @ self.w[d + "x"].T
        grad["embed"] = np.zeros_like(self.w["embed"])
        np.add.at(grad["embed"], keep["codes"], d_x)
        return grad


def _log_sum(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis=axis, keepdims=True)
    return (top + np.log(np.exp(x - top).sum(axis=axis, keepdims=True))).squeeze(axis)


def _crf_gradient(scores: np.ndarray, step: np.ndarray, tags: np.ndarray, live: np.ndarray):
    """Expected less actual counts of tags and of transitions, by forward and backward sums."""
    time, batch, _ = scores.shape
    forward, backward = np.zeros_like(scores), np.zeros_like(scores)
    forward[0] = scores[0]
    for t in range(1, time):
        new = _log_sum(forward[t - 1][:, :, None] + step, 1) + scores[t]
        forward[t] = np.where(live[t][:, None] > 0, new, forward[t - 1])
    total = _log_sum(forward[-1], 1)
    for t in range(time - 2, -1, -1):
        new = _log_sum(step + (scores[t + 1] + backward[t + 1])[:, None, :], 2)
        backward[t] = np.where(live[t + 1][:, None] > 0, new, backward[t + 1])
    d_scores = np.exp(forward + backward - total[:, None]) * live[:, :, None]
    rows = np.arange(batch)
    d_step = np.zeros_like(step)
    for t in range(time):
        d_scores[t, rows, tags[t]] -= live[t]
        if t:
            both = forward[t - 1][:, :, None] + step + (scores[t] + backward[t])[:, None, :] - total[:, None, None]
            d_step += (np.exp(both) * live[t][:, None, None]).sum(axis=0)
            np.subtract.at(d_step, (tags[t - 1], tags[t]), live[t])
    return d_scores.astype(np.float32), d_step.astype(np.float32)


def train(codes: np.ndarray, tags: np.ndarray) -> Tagger:
    """Adam over batches in a fixed order."""
    model, rng = Tagger(), np.random.default_rng(11)
    first = {k: np.zeros_like(v) for k, v in model.w.items()}
    second = {k: np.zeros_like(v) for k, v in model.w.items()}
    for n in range(1, TRAIN_STEPS + 1 if len(codes) else 1):
        pick = rng.integers(0, len(codes), min(TRAIN_BATCH, len(codes)))
        grad = model.learn_from(codes[pick], tags[pick])
        size = np.sqrt(sum(float((g**2).sum()) for g in grad.values()))
        rate = 0.02 * (1 - 0.9 * n / TRAIN_STEPS) / (1 if size < 5 else size / 5)
        for k, g in grad.items():
            first[k] = 0.9 * first[k] + 0.1 * g
            second[k] = 0.99 * second[k] + 0.01 * g * g
            model.w[k] = model.w[k] - np.float32(rate) * (first[k] / (1 - 0.9**n)) / (np.sqrt(second[k] / (1 - 0.99**n)) + 1e-6)
    return model


def best_paths(scores: np.ndarray, lengths: np.ndarray, step: np.ndarray) -> np.ndarray:
    """Viterbi over (batch, time, tag)."""
    batch, time, _ = scores.shape
    best = scores[:, 0]
    back = np.zeros((time, batch, TAGS), np.int8)
    for t in range(1, time):
        through = best[:, :, None] + step
        back[t] = through.argmax(axis=1)
        best = np.where((t < lengths)[:, None], through.max(axis=1) + scores[:, t], best)
        back[t][t >= lengths] = np.arange(TAGS)
    path = np.zeros((batch, time), np.int64)
    path[:, -1] = best.argmax(axis=1)
    rows = np.arange(batch)
    for t in range(time - 1, 0, -1):
        path[:, t - 1] = back[t][rows, path[:, t]]
    return path


def decode(model: Tagger, texts: list[str]) -> list[np.ndarray]:
    """Tags of each stretch, from all windows that cover it."""
    codes = [_codes(t) for t in texts]
    cuts = [_cuts(len(c)) for c in codes]
    owners = np.repeat(np.arange(len(codes)), [len(c) for c in cuts])
    starts = np.concatenate([np.array(c, np.int64) for c in cuts]) if cuts else np.zeros(0, np.int64)
    weight = np.minimum(np.arange(1, WINDOW + 1), np.arange(WINDOW, 0, -1)).astype(np.float32)
    total = [np.zeros((len(c), TAGS), np.float32) for c in codes]
    share = [np.zeros(len(c), np.float32) for c in codes]
    for at in range(0, len(starts), BATCH_WINDOWS):
        who, begin = owners[at : at + BATCH_WINDOWS], starts[at : at + BATCH_WINDOWS]
        block = np.zeros((len(who), WINDOW), np.int64)
        for row, (o, s) in enumerate(zip(who, begin)):
            piece = codes[o][s : s + WINDOW]
            block[row, : len(piece)] = piece
        scores = model.scores(block).transpose(1, 0, 2)
        for row, (o, s) in enumerate(zip(who, begin)):
            n = min(WINDOW, len(codes[o]) - s)
            total[o][s : s + n] += scores[row, :n] * weight[:n, None]
            share[o][s : s + n] += weight[:n]
    out: list[np.ndarray] = [np.zeros(0, np.int64)] * len(codes)
    order = sorted(range(len(codes)), key=lambda i: len(codes[i]))
    at = 0
    while at < len(order):
        # As many stretches of like length as make a block of bounded size.
        group, longest = [], 0
        while at < len(order) and (not group or len(codes[order[at]]) * (len(group) + 1) <= 1 << 16):
            group.append(order[at])
            longest = len(codes[order[at]])
            at += 1
        block = np.zeros((len(group), longest, TAGS), np.float32)
        for row, i in enumerate(group):
            block[row, : len(codes[i])] = total[i] / share[i][:, None]
        lengths = np.array([len(codes[i]) for i in group])
        for row, path in enumerate(best_paths(block, lengths, model.w["step"])):
            out[group[row]] = path[: lengths[row]]
    return out


def decoded_spans(model: Tagger, texts: list[str]) -> list[list[Span]]:
    """The network's spans of each text, by place."""
    out: list[list[Span]] = [[] for _ in texts]
    held: list[tuple[int, int, int, int, int]] = []
    chars = 0

    def flush() -> None:
        for (i, a, _, low, high), tags in zip(held, decode(model, [texts[i][a:b] for i, a, b, _, _ in held])):
            if tags.any():
                out[i] += [x for x in _spans_of(tags, a) if low <= x[1] < high]
        held.clear()

    for i, text in enumerate(texts):
        for stretch in stretches(text):
            for a, b, low, high in _pieces(*stretch):
                held.append((i, a, b, low, high))
                chars += b - a
                if chars >= AT_ONCE:
                    flush()
                    chars = 0
    flush()
    return out


def _spans_of(tags: np.ndarray, start: int) -> list[Span]:
    out: list[Span] = []
    for i, tag in enumerate(tags.tolist()):
        kind = (tag - 1) // 2
        if tag and tag % 2 == 0 and out and out[-1][0] == kind and out[-1][2] == start + i:
            out[-1] = (kind, out[-1][1], start + i + 1)
        elif tag:
            out.append((kind, start + i, start + i + 1))
    return out


def _plausible(kind: int, text: str) -> bool:
    """Is the text, brought to the plain form of its kind, one of that kind?"""
    if kind == 0:
        at = _SPELLED_AT.split(text)
        plain = "@".join([at[0], _SPELLED_DOT.sub(".", at[1])]) if len(at) == 2 else ""
        return list(_emails(plain)) == [(0, len(plain))] and bool(plain)
    if kind == 4:
        whole = 16 <= len(text) <= 128 and all(c.isascii() and (c.isalnum() or c in "_+/=-") for c in text)
        return whole and any(c.isdigit() for c in text) and any(c.isalpha() for c in text)
    between = {x.lower() for x in _SEPARATOR.findall(text.strip("+("))}
    if kind == 1:
        parts = _SEPARATOR.split(text)
        alike = len(between) == 1 and between.pop().strip(" []()") in (".", ",", "-", ":", "dot")
        return len(parts) == 4 and alike and _is_ip(".".join(parts))
    narrow = all(len(x) <= 3 and not any(c.isalnum() or c in "@\n" for c in x) for x in between)
    return narrow and len(text) <= 64 and (_is_card(text) if kind == 2 else _is_phone(text))


def _fitted(text: str, kind: int, a: int, b: int) -> Span:
    """The decoded span with exact ends, as the kind whose test it passes; kind -1 if none.

    Addresses reach as far around their at sign as one can; other spans are whole words.
    """
    low, high = max(0, a - WIDEN), min(len(text), b + WIDEN)
    if kind == 0:
        for at in _SPELLED_AT.finditer(text, low, high):
            start = at.start()
            while start > low and text[start - 1] in _LOCAL_CHARS:
                start -= 1
            domain = _SPELLED_DOMAIN.match(text, at.end(), high)
            while start < at.start() and text[start] in "._%+-":
                start += 1
            if start < at.start() and domain and start < b and a < domain.end():
                return (0, start, domain.end()) if _plausible(0, text[start : domain.end()]) else (-1, a, b)
        return -1, a, b
    while a < b and not (text[a].isalnum() or text[a] in "+("):
        a += 1
    while a < b and not text[b - 1].isalnum():
        b -= 1
    if a < b:
        while a > low and text[a].isalnum() and text[a - 1].isalnum():
            a -= 1
        while b < high and text[b].isalnum():
            b += 1
    for other in (4,) if kind == 4 else (1, kind, 2, 3):
        if a < b and _plausible(other, text[a:b]):
            return other, a, b
    return -1, a, b


def added_spans(text: str, found: list[Span], base: list[Span]) -> list[Span]:
    """Decoded spans, as whole words less what surrounds them, that overlap no base span and fit their kind."""
    out: list[Span] = []
    taken = sorted((a, b) for _, a, b in base)
    starts = [a for a, _ in taken]
    reached = list(accumulate((b for _, b in taken), max))
    last = 0
    for kind, a, b in found:
        kind, a, b = _fitted(text, kind, max(a, last), b)
        before = bisect_left(starts, b)
        if kind >= 0 and not (before and reached[before - 1] > a):
            out.append((kind, a, b))
            last = b
    return out


# -- Spark --------------------------------------------------------------------------


def labelled_spans(text: str, base: list[Span]) -> list[Span]:
    """The base spans, none over another, and secrets; by place."""
    secrets = [(4, m.start(1), m.end(1)) for m in _SECRET.finditer(text) if _plausible(4, m.group(1))]
    out: list[Span] = []
    for kind, a, b in sorted(base + secrets, key=lambda x: (x[1], -x[2])):
        if not out or a >= out[-1][2]:
            out.append((kind, a, b))
    return out


_SPELLINGS = (
    (" at ", " dot "), (" at ", " dot "), (" at ", " dot "), (" at ", "."), (" [at] ", " [dot] "), ("[at]", "[dot]"), ("[at]", "."),
    (" (at) ", " (dot) "), ("(at)", "."), ("(at)", "(dot)"), (" @ ", "."), (" @ ", " . "), (" AT ", " DOT "),
)
_IP_SEPARATORS = (",", "-", " . ", "[.]", " dot ", ":", ", ")
_CARD_SEPARATORS = (".", "/", "_", " - ", "  ", ". ")
_ENDINGS = ("com", "org", "net", "de", "io", "fr", "edu", "es")


def _other_form(kind: int, found: str, words: list[str], turn: Callable[[int], int]) -> tuple[str, int, int]:
    """Another way to write what was found, and where in it the span is; (0, 0): a decoy without one."""
    one = lambda options: options[turn(len(options))]
    word = lambda: one(words) if words else "site"
    if kind == 0:
        if turn(10) == 0:  # prose with the words that spell addresses
            decoy = one((f"{word()} at {word()} {word()}", f"at {word()}. {word().title()}", f"{word()} at {turn(99)}"))
            return decoy, 0, 0
        local, _, domain = found.partition("@")
        parts = domain.split(".")
        if turn(2):
            local = one((word(), f"{word()}.{word()}", f"{word()}{turn(100)}", f"{word()[:1]}.{word()}", f"{word()}_{word()}"))
            parts = [word(), one(_ENDINGS)]
        at, dot = one(_SPELLINGS)
        text = local + at + dot.join(parts)
        return text, 0, len(text)
    if kind == 1:
        text = one(_IP_SEPARATORS).join(str(turn(256)) if turn(2) else x for x in found.split("."))
        return text, 0, len(text)
    digits = _only_digits(found)
    if kind == 2:
        text = one(_CARD_SEPARATORS).join(digits[i : i + 4] for i in range(0, len(digits), 4))
        return text, 0, len(text)
    if kind == 3:
        sep = one((".", "-", " ", "/"))
        tail = "".join(str(turn(10)) if turn(2) else d for d in digits[-10:]).zfill(10)
        local = sep.join((tail[:3], tail[3:6], tail[6:]))
        country = digits[:-10] if turn(2) and len(digits) > 10 else str(1 + turn(99))
        text = one((found[1:], f"{country} ({tail[:3]}) {tail[3:6]}-{tail[6:]}", f"00{country} {local}", f"00{country}{sep}{local}",
                    local, local, f"{country}{sep}{local}", f"({tail[:3]}) {tail[3:6]}-{tail[6:]}"))
        skip = one((0, 0, 5))
        return "tel. "[:skip] + text, skip, skip + len(text)
    text = "".join(one(found) for _ in found)
    return text, 0, len(text) if _plausible(4, text) else 0


def rewritten(text: str, spans: list[Span], version: int) -> tuple[str, list[Span]]:
    """The text with every labelled span in another form, chosen by a hash of it; labels follow."""
    out, labels, at, length = [], [], 0, 0
    for kind, a, b in spans:
        found = text[a:b]
        seed = hashlib.blake2b(f"{version} {a} {found}".encode("utf-8", "surrogatepass"), digest_size=8).digest()
        rng = np.random.default_rng(int.from_bytes(seed, "big"))
        near = _WORDS.findall(text[max(0, a - 200) : a] + " " + text[b : b + 200])
        form, low, high = _other_form(kind, found, near, lambda n: int(rng.integers(0, n)))
        out += [text[at:a], form]
        length += a - at
        if high:
            labels.append((kind, length + low, length + high))
        length += len(form)
        at = b
    return "".join([*out, text[at:]]), labels


def training_windows(docs: DataFrame, limit: int = TRAIN_WINDOWS) -> DataFrame:
    """At most ``limit`` windows (codes, tags): by a hash, those with spans first."""

    def per_batch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("bare", pa.int32()), ("turn", pa.int64()), ("codes", pa.binary()), ("tags", pa.binary())])
        for batch in slices(batches, "text", BATCH_BYTES):
            out = []
            for text in batch.column("text").to_pylist():
                if not text or not _TRIGGER.search(text):
                    continue
                spans = labelled_spans(text, base_spans(text))
                versions = [(text, spans), *(rewritten(text, spans, n) for n in range(VERSIONS if spans else 0))]
                for other, labels in versions:
                    starts = [x for _, x, _ in labels]
                    for a, b in stretches(other):
                        for s in _cuts(b - a):
                            low, high = a + s, min(b, a + s + WINDOW)
                            piece = other[low:high]
                            near = labels[max(0, bisect_left(starts, low) - 1) : bisect_left(starts, high)]
                            tags = _tags(len(piece), near, low).astype(np.uint8).tobytes()
                            codes = _codes(piece).astype(np.uint8).tobytes()
                            turn = int.from_bytes(hashlib.blake2b(codes, digest_size=7).digest(), "big")
                            out.append((0 if any(tags) or turn % 4 == 0 else 1, turn, codes, tags))
            out = sorted(set(out))[:limit]
            yield pa.RecordBatch.from_arrays([pa.array([x[i] for x in out], f.type) for i, f in enumerate(schema)], schema=schema)

    windows = docs.select("text").mapInArrow(per_batch, "bare int, turn bigint, codes binary, tags binary")
    return windows.distinct().orderBy("bare", "turn", "tags").limit(limit)


def fit(docs: DataFrame, limit: int = TRAIN_WINDOWS) -> dict[str, np.ndarray]:
    """Train in one task, on the bounded sample; the driver gets the weights."""

    def in_one_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = [(c, t) for batch in batches for c, t in zip(batch.column("codes").to_pylist(), batch.column("tags").to_pylist())]
        rows.sort()
        codes, tags = np.zeros((len(rows), WINDOW), np.int64), np.zeros((len(rows), WINDOW), np.int64)
        for i, (c, t) in enumerate(rows):
            codes[i, : len(c)], tags[i, : len(t)] = np.frombuffer(c, np.uint8), np.frombuffer(t, np.uint8)
        model = train(codes, tags)
        yield pa.RecordBatch.from_pydict({
            "name": list(model.w), "shape": [list(v.shape) for v in model.w.values()],
            "value": [v.astype(np.float32).tobytes() for v in model.w.values()],
        }, pa.schema([("name", pa.string()), ("shape", pa.list_(pa.int32())), ("value", pa.binary())]))

    sample = training_windows(docs, limit).coalesce(1)
    rows = sample.mapInArrow(in_one_task, "name string, shape array<int>, value binary").collect()
    return {r["name"]: np.frombuffer(r["value"], np.float32).reshape(r["shape"]) for r in rows}


def find_personal_data(docs: DataFrame, weights: dict[str, np.ndarray] | None = None) -> DataFrame:
    """(doc_id, counts and digest of the base spans, all spans, their number) of each row."""
    weights = fit(docs) if weights is None else weights

    def per_batch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = Tagger(weights)
        for batch in slices(batches, "text", BATCH_BYTES):
            texts = [t or "" for t in batch.column("text").to_pylist()]
            base = [base_spans(t) for t in texts]
            more = decoded_spans(model, texts)
            columns = [batch.column("doc_id")]
            for kind in range(len(KINDS)):
                columns.append(pa.array([sum(s[0] == kind for s in spans) for spans in base], pa.int64()))
            columns.append(pa.array([hashlib.sha256(listed(s).encode()).hexdigest() for s in base], pa.string()))
            full = [s + added_spans(t, m, s) for t, s, m in zip(texts, base, more)]
            columns.append(pa.array([listed(s) for s in full], pa.string()))
            columns.append(pa.array([len(s) for s in full], pa.int64()))
            names = ["doc_id", *[f"n_{k}" for k in KINDS], "base_sha256", "spans", "n_spans"]
            yield pa.RecordBatch.from_arrays(columns, names=names)

    counts = ", ".join(f"n_{k} bigint" for k in KINDS)
    return docs.select("doc_id", "text").mapInArrow(per_batch, f"doc_id bigint, {counts}, base_sha256 string, spans string, n_spans bigint")
