"""Personal data by a character-level bidirectional LSTM with CRF transitions.

The network is trained here, in numpy, on labelled windows: invented prose
with e-mail addresses, IP addresses, card and phone numbers in the forms of
the base patterns and in forms that those miss (``name (at) host dot org``,
phone numbers without a plus sign, cards grouped by dots), and with look-alikes
that carry no label (dates, prices, versions, hex strings).

A text is cut into windows that overlap by half, more than the longest form of
an added span (LONGEST).  Windows that hold a digit, an ``@`` or a spelled-out
separator of an address are decoded by Viterbi; every form of FORMS holds one of
these, so the others can't add a span.  Spans cut off by a window's edge are
left to the window that holds them whole; of all spans of a text the
non-overlapping choice with the largest total score is taken, after exact checks
(digits and check sum of cards, digits of phones, parts of addresses).  Base
spans always stay; the network adds spans outside them.

Defined cases: a null or empty text has no spans; spans longer than LONGEST
characters are found by the base patterns only; a text shorter than a window is
padded; repeated rows are scanned alike; an empty table gives an empty result;
other columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from threadlens.llm import words as W
from threadlens.llm.shared import ship

KINDS = ("email", "ip", "card", "phone")
# The base patterns.
EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
DIGIT = re.compile("[0-9]")
# What every form of an added span holds: a digit, an at sign or a spelled-out separator (" at " only before a name with a dot).
_TRIGGER = r"[0-9@]|[(\[](?:at|dot)[)\]]|\x20dot\x20|\x20at\x20[a-z0-9-]+\.[a-z0-9-]"
TRIGGER, TRIGGER_BYTES = re.compile(_TRIGGER, re.I), re.compile(_TRIGGER.encode(), re.I)

#: Characters of a window and between windows; the longest added span; characters of a training window.
WINDOW, STRIDE, LONGEST, TRAINING = 192, 96, 96, 96
#: Windows decoded at once.
CHUNK = 256
#: Sizes of the network and its training; the least log odds of a span (an address must have its form as well).
EMBED, HIDDEN, SAMPLES, STEPS, BATCH, SEED = 10, 20, 4000, 1000, 48, 20240917
LEAST_SCORE = {"email": 0.0, "email with a plain at": 1.0, "ip": 3.0, "card": 3.0, "phone": 1.0}

LABELS = ["O", *(f"{p}-{k}" for k in KINDS for p in "BI")]
_PUNCT = "@.-+() _:/,\n[]#%$€&*'\"="
_VOCAB = 1 + 26 + 1 + len(_PUNCT) + 2


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        total += d if i % 2 == 0 else 2 * d - 9 * (d > 4)
    return total % 10 == 0


def digits_of(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def is_card(text: str) -> bool:
    d = digits_of(text)
    return 12 <= len(d) <= 19 and luhn(d)


def base_spans(text: str) -> list[tuple[int, int, str]]:
    """(start, end, kind) of the base patterns, by start and then kind."""
    out = []
    if "@" in text:
        out += [(*m.span(), "email") for m in EMAIL.finditer(text)]
    if DIGIT.search(text):
        out += [(*m.span(), "ip") for m in IP.finditer(text) if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m[0].split("."))]
        out += [(*m.span(), "card") for m in CARD.finditer(text) if is_card(m[0])]
        if "+" in text:
            out += [(*m.span(), "phone") for m in PHONE.finditer(text) if 9 <= len(digits_of(m[0])) <= 15]
    return sorted(out, key=lambda s: (s[0], KINDS.index(s[2])))


# ---------------------------------------------------------------- labelled windows

_SYLLABLES = "the an on er re in th ed es st ent tion ble ung ein sch keit que eux ai le la os ción ado mente ra ño é ü ß".split()
_TLDS = "com org net de fr es io example.com co.uk edu".split()


def _word(rng: np.random.Generator) -> str:
    w = "".join(rng.choice(_SYLLABLES, rng.integers(1, 4)))
    return w.capitalize() if rng.random() < 0.12 else w


def _name(rng: np.random.Generator) -> str:
    return "".join(rng.choice(list("abcdefghijklmnoprstuvw"), rng.integers(2, 9)))


def _digits(rng: np.random.Generator, n: int) -> str:
    return "".join(map(str, rng.integers(0, 10, n)))


def _email(rng: np.random.Generator) -> str:
    local = _name(rng) + rng.choice([".", "_", "", "-"]) + (_digits(rng, 2) if rng.random() < 0.5 else _name(rng))
    host, tld = _name(rng) + (_digits(rng, 1) if rng.random() < 0.3 else ""), rng.choice(_TLDS)
    if rng.random() < 0.45:
        return f"{local}@{host}.{tld}"
    at = str(rng.choice(["@", " (at) ", "(at)", " [at] ", "[at]", " at ", " at "]))
    dot = str(rng.choice([".", " (dot) ", "(dot)", " [dot] ", "[dot]", " dot ", " dot "]))
    return f"{local}{at}{host}{tld.replace('.', dot).join([dot, ''])}"


def _card(rng: np.random.Generator) -> str:
    body = str(rng.integers(3, 7)) + _digits(rng, 14)
    number = next(body + str(c) for c in range(10) if luhn(body + str(c)))
    sep = rng.choice(["", "", " ", "-", ".", "  "])
    return sep.join(number[i: i + 4] for i in range(0, 16, 4))


def _phone(rng: np.random.Generator) -> str:
    a, b, c = _digits(rng, 3), _digits(rng, 3), _digits(rng, 4)
    cc, d = rng.integers(20, 99), _digits(rng, 7)
    return str(rng.choice([
        f"+1 ({a}) {b}-{c}", f"+{cc} {a} {b} {c}", f"+{cc}{a}{b}{c}", f"({a}) {b}-{c}", f"({a}) {b}-{c}", f"({a}) {b} {c}", f"{a}-{b}-{c}", f"{a}-{b}-{c}",
        f"{a}-{b}-{c}", f"{a}.{b}.{c}", f"{a}.{b}.{c}", f"00{cc} {a} {b}{c}", f"00{cc} {a} {d}", f"00{cc} {a} {d}", f"00{cc}{a}{d}", f"00{cc} {a} {b} {c}"]))


def _ip(rng: np.random.Generator) -> str:
    return ".".join(map(str, rng.integers(0, 256, 4)))


def _look_alike(rng: np.random.Generator) -> str:
    n = lambda lo, hi: int(rng.integers(lo, hi))
    hexes = "".join(rng.choice(list("0123456789abcdef"), n(8, 40)))
    return str(rng.choice([
        f"{n(1900, 2100)}-{n(1, 13):02d}-{n(1, 29):02d}", f"{n(1, 29)}.{n(1, 13)}.{n(1900, 2100)}", f"{n(0, 24):02d}:{n(0, 60):02d}", f"{n(1, 999)},{n(0, 1000):03d}.{n(0, 100):02d}",
        f"{n(1, 20)}.{n(0, 20)}.{n(0, 20)}", f"{n(0, 100000)}", f"#{n(1000, 99999999)}", f"{n(1900, 2000)}-{n(2000, 2030)}", f"{n(1, 100)}%", f"${n(1, 9999)}.{n(0, 100):02d}",
        hexes, f"password={hexes}", f'token = "{hexes}"', "AKIA" + "".join(rng.choice(list("ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"), 16)), f"4.0 {_word(rng)}",
        _digits(rng, n(9, 24)), f"{_digits(rng, 4)} {_digits(rng, 4)}", f"@{_name(rng)}", f"{_word(rng)} at {_word(rng)}", f"{n(1, 9)}/{n(1, 20)}", f"{n(1, 20)}-{n(1, 400)}", f"{_word(rng)} dot {_word(rng)}",
        " ".join(_digits(rng, 3) for _ in range(n(2, 6))), " ".join(_digits(rng, 3) for _ in range(4)), " ".join(_digits(rng, 2) for _ in range(n(3, 8))), " ".join(_digits(rng, n(1, 5)) for _ in range(n(2, 7))),
        f"978-{n(0, 10)}-{n(10, 100)}-{n(100000, 999999)}-{n(0, 10)}", f"{_digits(rng, 2)}-{_digits(rng, 3)}-{_digits(rng, 3)}", f"{n(1, 999)}.{n(0, 1000):03d}.{n(0, 1000):03d}", "-".join(_digits(rng, n(2, 6)) for _ in range(n(2, 5))),
        f"{_digits(rng, 8)}-{_digits(rng, 4)}-{_digits(rng, 4)}", f"{_word(rng)} at {_word(rng)}.{_word(rng).capitalize()}", f"{_word(rng)} at {_word(rng)}.{_word(rng).capitalize()}", f"{_word(rng)} at {_word(rng)}. {_word(rng).capitalize()}", f"{_word(rng)} [dot] {_word(rng)}", f"({_word(rng)}) {n(1, 9999)}"]))


def labelled_windows(n: int, rng: np.random.Generator) -> tuple[np.ndarray, np.ndarray]:
    """(character ids, labels) of n windows; every fourth is the end of a text, padded."""
    makers = {"email": _email, "ip": _ip, "card": _card, "phone": _phone}
    x, y = np.zeros((n, TRAINING), np.int64), np.zeros((n, TRAINING), np.int64)
    for row in range(n):
        text, marks = "", []
        size = TRAINING if row % 4 else int(rng.integers(8, TRAINING))
        while len(text) < size + 40:
            r = rng.random()
            kind = None
            if r < 0.15:
                kind = str(rng.choice(KINDS, p=[0.45, 0.1, 0.15, 0.3]))
                piece = makers[kind](rng)
            else:
                piece = _look_alike(rng) if r < 0.3 else _word(rng)
            if kind:
                marks.append((len(text), len(text) + len(piece), kind))
            text += piece + str(rng.choice([" ", " ", " ", ", ", ". ", "\n"]))
        cut = int(rng.integers(0, 40))
        ids = encode(text)[cut: cut + size]
        x[row, : len(ids)] = ids
        for a, b, kind in marks:
            own = 1 + 2 * KINDS.index(kind)
            a, b = max(a - cut, 0), min(b - cut, size)
            if b > a:
                y[row, a:b] = own + 1
                y[row, a] = own
    return x, y


# ---------------------------------------------------------------- the network

def _table() -> np.ndarray:
    ids = np.zeros(128, np.int64)
    for c in range(128):
        ch = chr(c)
        if ch.isalpha():
            ids[c] = 1 + ord(ch.lower()) - 97
        elif ch.isdigit():
            ids[c] = 27
        elif ch in _PUNCT:
            ids[c] = 28 + _PUNCT.index(ch)
    return ids


_IDS = _table()


def encode(text: str) -> np.ndarray:
    """Vocabulary ids of the characters of a text."""
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    return np.where(codes < 128, _IDS[np.minimum(codes, 127)], _VOCAB - 1)


def _allowed() -> np.ndarray:
    """0 where a transition is possible, a large negative number elsewhere."""
    out = np.zeros((len(LABELS), len(LABELS)))
    for a, one in enumerate(LABELS):
        for b, two in enumerate(LABELS):
            if two[0] == "I" and one[1:] != two[1:]:
                out[a, b] = -1e4
    return out


class Network:
    """Embedding, two LSTMs, a linear layer and CRF transitions; ``fit`` trains them by Adam."""

    def __init__(self, seed: int = SEED):
        rng = np.random.default_rng(seed)
        n, h, e = len(LABELS), HIDDEN, EMBED
        draw = lambda *s: (rng.standard_normal(s) / np.sqrt(s[0])).astype(np.float32)
        self.p = {"emb": draw(_VOCAB, e) * 3, "out": draw(2 * h, n), "bias": np.zeros(n, np.float32), "trans": np.zeros((n, n), np.float32)}
        for side in "fb":
            self.p |= {f"x{side}": draw(e, 4 * h), f"h{side}": draw(h, 4 * h), f"c{side}": np.zeros(4 * h, np.float32)}
            self.p[f"c{side}"][h: 2 * h] = 1.0
        self.mask = _allowed().astype(np.float32)

    def _lstm(self, x: np.ndarray, side: str) -> tuple[np.ndarray, list]:
        """Hidden states (T, N, H) and what the gradient needs."""
        p, h = self.p, HIDDEN
        inputs = (p["emb"] @ p[f"x{side}"] + p[f"c{side}"])[x.T]
        steps = range(x.shape[1]) if side == "f" else range(x.shape[1] - 1, -1, -1)
        state, cell = np.zeros((len(x), h), np.float32), np.zeros((len(x), h), np.float32)
        out, trace = np.zeros((x.shape[1], len(x), h), np.float32), []
        for t in steps:
            z = inputs[t] + state @ p[f"h{side}"]
            gates = 0.5 * (np.tanh(0.5 * z[:, : 3 * h]) + 1)
            g = np.tanh(z[:, 3 * h:])
            before = (state, cell)
            cell = gates[:, h: 2 * h] * cell + gates[:, :h] * g
            squashed = np.tanh(cell)
            state = gates[:, 2 * h:] * squashed
            out[t] = state
            trace.append((t, gates, g, squashed, *before))
        return out, trace

    def emissions(self, x: np.ndarray) -> np.ndarray:
        """(T, N, labels)."""
        return np.concatenate([self._lstm(x, "f")[0], self._lstm(x, "b")[0]], axis=2) @ self.p["out"] + self.p["bias"]

    def _crf(self, e: np.ndarray, y: np.ndarray) -> tuple[float, np.ndarray, np.ndarray]:
        """Negative log likelihood a window, its gradients by emissions and by transitions."""
        t_max, n, k = e.shape
        trans = self.p["trans"] + self.mask
        alpha, beta = np.zeros_like(e), np.zeros_like(e)
        alpha[0] = e[0]
        for t in range(1, t_max):
            s = alpha[t - 1][:, :, None] + trans
            top = s.max(axis=1)
            alpha[t] = top + np.log(np.exp(s - top[:, None]).sum(axis=1)) + e[t]
        for t in range(t_max - 2, -1, -1):
            s = trans + (beta[t + 1] + e[t + 1])[:, None]
            top = s.max(axis=2)
            beta[t] = top + np.log(np.exp(s - top[:, :, None]).sum(axis=2))
        top = alpha[-1].max(axis=1, keepdims=True)
        z = (top[:, 0] + np.log(np.exp(alpha[-1] - top).sum(axis=1)))
        by_e = np.exp(alpha + beta - z[None, :, None])
        by_t = np.zeros((k, k), np.float32)
        for t in range(1, t_max):
            by_t += np.exp(alpha[t - 1][:, :, None] + trans + (e[t] + beta[t])[:, None] - z[:, None, None]).sum(axis=0)
        rows, steps = np.arange(n), np.arange(t_max)
        gold = e[steps[:, None], rows[None], y.T].sum(axis=0) + trans[y[:, :-1], y[:, 1:]].sum(axis=1)
        by_e[steps[:, None], rows[None], y.T] -= 1
        np.add.at(by_t, (y[:, :-1].ravel(), y[:, 1:].ravel()), -1)
        return float((z - gold).mean()), by_e / n, by_t / n

    def gradients(self, x: np.ndarray, y: np.ndarray) -> tuple[float, dict[str, np.ndarray]]:
        p, h = self.p, HIDDEN
        sides = {s: self._lstm(x, s) for s in "fb"}
        states = np.concatenate([sides["f"][0], sides["b"][0]], axis=2)
        loss, by_e, by_t = self._crf(states @ p["out"] + p["bias"], y)
        flat = by_e.reshape(-1, by_e.shape[2])
        g = {k: np.zeros_like(v) for k, v in p.items()} | {"out": states.reshape(-1, 2 * h).T @ flat, "bias": flat.sum(axis=0), "trans": np.where(self.mask < 0, 0, by_t)}
        into = by_e @ p["out"].T
        for at, side in ((0, "f"), (h, "b")):
            d_state, d_cell = np.zeros((len(x), h), np.float32), np.zeros((len(x), h), np.float32)
            d_inputs = np.zeros((x.shape[1], len(x), 4 * h), np.float32)
            for t, gates, cand, squashed, state, cell in reversed(sides[side][1]):
                d_state = d_state + into[t][:, at: at + h]
                i, f, o = gates[:, :h], gates[:, h: 2 * h], gates[:, 2 * h:]
                d_cell = d_cell + d_state * o * (1 - squashed**2)
                dz = np.concatenate([d_cell * cand * i * (1 - i), d_cell * cell * f * (1 - f), d_state * squashed * o * (1 - o), d_cell * i * (1 - cand**2)], axis=1)
                d_inputs[t] = dz
                g[f"h{side}"] += state.T @ dz
                d_state, d_cell = dz @ p[f"h{side}"].T, d_cell * f
            by_id = np.zeros((_VOCAB, 4 * h), np.float32)
            np.add.at(by_id, x.T.ravel(), d_inputs.reshape(-1, 4 * h))
            g[f"x{side}"] += p["emb"].T @ by_id
            g[f"c{side}"] += by_id.sum(axis=0)
            g["emb"] += by_id @ p[f"x{side}"].T
        return loss, g

    def fit(self, steps: int = STEPS, seed: int = SEED) -> float:
        rng = np.random.default_rng(seed)
        x, y = labelled_windows(SAMPLES, rng)
        m, v = {k: np.zeros_like(w) for k, w in self.p.items()}, {k: np.zeros_like(w) for k, w in self.p.items()}
        loss = 0.0
        for step in range(1, steps + 1):
            rows = rng.choice(len(x), BATCH, replace=False)
            loss, g = self.gradients(x[rows], y[rows])
            norm = np.sqrt(sum(float((w * w).sum()) for w in g.values()))
            rate = 0.02 * (1 if step < steps * 0.6 else 0.3 if step < steps * 0.85 else 0.1)
            for k, w in g.items():
                w = w * min(1.0, 5.0 / max(norm, 1e-9))
                m[k] = 0.9 * m[k] + 0.1 * w
                v[k] = 0.99 * v[k] + 0.01 * w * w
                self.p[k] = (self.p[k] - rate * (m[k] / (1 - 0.9**step)) / (np.sqrt(v[k] / (1 - 0.99**step)) + 1e-8)).astype(np.float32)
        return loss

    def decode(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(labels, their lead over O) of every character, both (N, T), by Viterbi."""
        e = self.emissions(x)
        trans = self.p["trans"] + self.mask
        best, back = e[0], []
        for t in range(1, len(e)):
            s = best[:, :, None] + trans
            back.append(s.argmax(axis=1))
            best = s.max(axis=1) + e[t]
        path = [best.argmax(axis=1)]
        for b in reversed(back):
            path.append(b[np.arange(len(x)), path[-1]])
        labels = np.array(path[::-1])
        lead = np.take_along_axis(e, labels[:, :, None], axis=2)[:, :, 0] - e[:, :, 0]
        return labels.T, lead.T


@lru_cache(1)
def trained() -> Network:
    net = Network()
    net.fit()
    return net


# ---------------------------------------------------------------- texts

#: Exact forms that a proposed span must hold; it is trimmed to the form, or for addresses, whose parts are words, widened to it.
FORMS = {
    "email": re.compile(r"[A-Za-z0-9._%+-]+(?:@|\x20?[(\[]at[)\]]\x20?|\x20at\x20)[A-Za-z0-9-]+(?:(?:\.|\x20?[(\[]dot[)\]]\x20?|\x20dot\x20)[A-Za-z0-9-]+)+", re.I),
    "ip": IP,
    "card": re.compile(r"[0-9](?:[\x20.-]{0,2}[0-9])+"),
    "phone": re.compile(r"[+(]?[0-9][\x20()./0-9-]+[0-9]"),
}


def accepted(text: str, start: int, end: int, kind: str) -> tuple[int, int] | None:
    """The form that a proposed span of a text holds, if it passes the exact checks."""
    if kind == "email":
        around = FORMS[kind].finditer(text, max(0, start - LONGEST), end + LONGEST)
        m = next((m for m in around if 2 * (min(m.end(), end) - max(m.start(), start)) >= end - start), None)
    else:
        m = FORMS[kind].search(text, start, end)
    if m is None or m.end() - m.start() > LONGEST:
        return None
    digits = digits_of(m[0])
    if kind == "card" and not (12 <= len(digits) <= 19 and luhn(digits)):
        return None
    if kind == "phone" and not 9 <= len(digits) <= 15:
        return None
    if kind == "ip" and any(len(p) > 3 or int(p) > 255 for p in m[0].split(".")):
        return None
    return m.span()


def reconcile(spans: list[tuple[int, int, str, float]]) -> list[tuple[int, int, str]]:
    """The non-overlapping spans with the largest total score; equal spans of several windows count once, with their best score."""
    best: dict[tuple[int, int, str], float] = {}
    for a, b, kind, score in spans:
        best[a, b, kind] = max(score, best.get((a, b, kind), score))
    order = sorted(best, key=lambda s: (s[1], s[0], KINDS.index(s[2])))
    ends = np.array([s[1] for s in order])
    total, take = [0.0], []
    for i, s in enumerate(order):
        before = int(np.searchsorted(ends[:i], s[0], "right"))
        gain = total[before] + best[s]
        take.append((gain > total[-1], before))
        total.append(max(total[-1], gain))
    out, i = [], len(order)
    while i:
        on, before = take[i - 1]
        if on:
            out.append(order[i - 1])
            i = before
        else:
            i -= 1
    return out[::-1]


def proposals(text: str, net: Network) -> list[tuple[int, int, str, float]]:
    """Accepted spans of all windows of a text, with scores."""
    hits = np.array([m.start() for m in TRIGGER.finditer(text)])
    if not len(hits):
        return []
    last = max(0, -(-(len(text) - WINDOW) // STRIDE))
    windows = np.unique(np.concatenate([hits // STRIDE - 1, hits // STRIDE]).clip(0, last))
    ids = encode(text)
    out = []
    for at in range(0, len(windows), CHUNK):
        own = windows[at: at + CHUNK] * STRIDE
        place = own[:, None] + np.arange(WINDOW)
        x = np.where(place < len(ids), ids[np.minimum(place, len(ids) - 1)], 0)
        labels, lead = net.decode(x)
        trans = net.p["trans"]
        for w, start in enumerate(own.tolist()):
            row = labels[w]
            for b in np.flatnonzero(row % 2 == 1).tolist():
                e = b + 1
                while e < WINDOW and row[e] == row[b] + 1:
                    e += 1
                a, z = start + b, min(start + e, len(text))
                if (b == 0 and start) or (e == WINDOW and start + WINDOW < len(text)):
                    continue  # another window holds it whole
                # log odds of this part of the path against one without a span
                o, first, inner = 0, int(row[b]), int(row[b]) + 1
                steps = trans[o, first] + (trans[first, inner] + (e - b - 2) * trans[inner, inner] + trans[inner, o] if e - b > 1 else trans[first, o])
                score, kind = float(lead[w, b:e].sum() + steps - (e - b + 1) * trans[o, o]), KINDS[(first - 1) // 2]
                where = accepted(text, a, z, kind) if score >= LEAST_SCORE[kind] else None
                found = text[slice(*where)] if where else ""
                plain = kind == "email" and " at " in found.lower()
                if found and not (plain and (score < LEAST_SCORE["email with a plain at"] or found.rpartition(".")[2][:1].isupper())):
                    out.append((*where, kind, score))
    return out


def find_spans(text: str, net: Network) -> tuple[list[tuple[int, int, str]], list[tuple[int, int, str]]]:
    """(base spans, added spans) of a whole text."""
    base = base_spans(text)
    added = []
    for a, b, kind, score in proposals(text, net):
        if not any(a < y and x < b for x, y, _ in base):
            added.append((a, b, kind, score))
    return base, reconcile(added)


def listed(spans: list[tuple[int, int, str]]) -> str:
    return ",".join(f"{k}:{a}:{b}" for a, b, k in sorted(spans, key=lambda s: (s[0], KINDS.index(s[2]), s[1])))


_ANY = np.isin(np.arange(256), [*range(0x30, 0x3A), 0x40])


def scan(docs: DataFrame) -> DataFrame:
    """doc_id, ``base`` and ``added``: lists of (kind, start, end, the text itself) of every document."""
    spark = docs.sparkSession
    ship(spark)
    net = spark.sparkContext.broadcast(trained())
    span = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("text", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = W.buffers(batch.column(1))
            base, added = [], []
            for i in range(batch.num_rows):
                own = data[offsets[i]: offsets[i + 1]]
                raw = own.tobytes()
                if _ANY[own].any() or TRIGGER_BYTES.search(raw):
                    text = raw.decode("utf-8", "replace")
                    one, two = find_spans(text, net.value)
                else:
                    text, one, two = "", [], []
                row = lambda s: {"kind": s[2], "start": s[0], "end": s[1], "text": text[s[0]: s[1]]}  # noqa: E731, B023
                base.append([row(s) for s in one])
                added.append([row(s) for s in two])
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(base, pa.list_(span)), pa.array(added, pa.list_(span))], names=["doc_id", "base", "added"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    spans = "array<struct<kind:string,start:long,end:long,text:string>>"
    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, base {spans}, added {spans}")


def op3_bilstm_pii(docs: DataFrame) -> DataFrame:
    """doc_id, base counts, digest of the base spans, all spans, and how many the network added."""
    kind = docs.schema["doc_id"].dataType.simpleString()

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            base = [[(s["start"], s["end"], s["kind"]) for s in row] for row in batch.column(1).to_pylist()]
            added = [[(s["start"], s["end"], s["kind"]) for s in row] for row in batch.column(2).to_pylist()]
            counts = [pa.array([sum(s[2] == k for s in row) for row in base], pa.int64()) for k in KINDS]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *counts, pa.array([hashlib.sha256(listed(row).encode()).hexdigest() for row in base], pa.string()),
                 pa.array([listed(a + b) for a, b in zip(base, added)], pa.string()), pa.array(list(map(len, added)), pa.int64())],
                names=["doc_id", *(f"n_{k}" for k in KINDS), "base_sha256", "spans", "n_added"])

    return scan(docs).mapInArrow(digest, f"doc_id {kind}, {', '.join(f'n_{k} long' for k in KINDS)}, base_sha256 string, spans string, n_added long")
