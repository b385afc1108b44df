import hashlib
import itertools
import random
import re

import numpy as np
import pytest

from tests.llm.cases import awkward, empty, table
from threadlens.llm import pii as P


def brute(text):
    text, out = text or "", []
    digits = lambda s: re.sub("[^0-9]", "", s)

    def luhn(n):
        return sum(sum(divmod(int(c) * (1 + i % 2), 10)) for i, c in enumerate(reversed(n))) % 10 == 0

    out += [(m.start(), 0, m.end()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    out += [(m.start(), 1, m.end()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text) if all(int(p) <= 255 for p in m[0].split("."))]
    out += [(m.start(), 2, m.end()) for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text) if 12 <= len(digits(m[0])) <= 19 and luhn(digits(m[0]))]
    out += [(m.start(), 3, m.end()) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text) if 9 <= len(digits(m[0])) <= 15]
    return [(a, b, P.KINDS[k]) for a, k, b in sorted(out)]


@pytest.fixture(scope="module")
def net():
    return P.trained()


def test_gradients_equal_differences():
    rng, net = np.random.default_rng(0), P.Network(1)
    x, y = P.labelled_windows(2, rng)
    net.p = {k: v.astype(np.float64) for k, v in net.p.items()}
    net.mask = net.mask.astype(np.float64)
    _, g = net.gradients(x, y)
    for k, i in (("emb", (int(x[0, 5]), 2)), ("xf", (1, 7)), ("hb", (3, 40)), ("out", (20, 3)), ("trans", (0, 1)), ("cb", (33,)), ("bias", (2,))):
        old = net.p[k][i]
        net.p[k][i] = old + 1e-4
        up = net.gradients(x, y)[0]
        net.p[k][i] = old - 1e-4
        down = net.gradients(x, y)[0]
        net.p[k][i] = old
        assert g[k][i] == pytest.approx((up - down) / 2e-4, rel=1e-2, abs=1e-5), k


def test_viterbi_finds_the_best_path():
    net = P.Network(3)
    net.p["trans"] = np.random.default_rng(1).standard_normal(net.p["trans"].shape).astype(np.float32)
    x = np.random.default_rng(2).integers(0, P._VOCAB, (2, 4))
    e, trans = net.emissions(x), net.p["trans"] + net.mask
    labels, _ = net.decode(x)
    for row in range(2):
        best = max(itertools.product(range(len(P.LABELS)), repeat=4), key=lambda p: sum(e[t, row, p[t]] for t in range(4)) + sum(trans[a, b] for a, b in zip(p, p[1:])))
        assert labels[row].tolist() == list(best)


def test_held_out_windows(net):
    x, y = P.labelled_windows(300, np.random.default_rng(77))
    labels, _ = net.decode(x)
    assert (labels == y).mean() > 0.95 and (labels == y)[y > 0].mean() > 0.85


def test_reconciling_is_the_best_choice():
    rng = random.Random(4)
    for _ in range(60):
        spans = [(a := rng.randrange(20), a + rng.randrange(1, 8), rng.choice(P.KINDS), rng.random()) for _ in range(8)]
        best = max((c for r in range(9) for c in itertools.combinations(spans, r) if all(p[1] <= q[0] or q[1] <= p[0] for p, q in itertools.combinations(c, 2))), key=lambda c: sum(s[3] for s in c))
        got = P.reconcile(spans)
        assert all(p[1] <= q[0] for p, q in zip(got, got[1:]))
        score = {s[:3]: max(t[3] for t in spans if t[:3] == s[:3]) for s in spans}
        assert sum(score[s] for s in got) == pytest.approx(sum(s[3] for s in best))


def test_forms_that_the_base_misses(net):
    for text, want in (("please call me on (555) 123-4567 before noon", ("(555) 123-4567", "phone")), ("write to john.doe (at) mail dot com please", ("john.doe (at) mail dot com", "email"))):
        base, added = P.find_spans(text, net)
        assert base == [] and [(text[a:b], k) for a, b, k in added] == [want]
    for text in ("on 2024-01-15 at 12:30 we paid 1,234.56", "the cats at home dot the field", "version 1.2.3 of 987654321012", "password=8c95f79ef43c263259"):
        assert P.find_spans(text, net) == ([], [])


def test_a_span_is_found_wherever_the_windows_fall(net):
    number = "(555) 123-4567"
    for lead in range(40, 140, 7):
        text = ("the nation on the street " * 10)[:lead] + f" {number} " + "the nation on the street " * 6
        assert [(text[a:b]) for a, b, _ in P.find_spans(text, net)[1]] == [number]


def test_base_spans_equal_brute_force(spark):
    texts = ["a.b+c@x.y.z, 1.2.3.4.5 256.1.1.1 01.02.03.255", "4111 1111 1111 1111 4111-1111-1111-1112", "+1 (555) 123-4567 + 12 +1234567 +12345678901234567", "12@34.56 é\U0001f600 x@y.zz", "1" * 50 + ".1.1.1"]
    for text in texts:
        assert P.base_spans(text) == brute(text)
    docs = table(spark, "documents", "sf0.01")
    by = {r.doc_id: brute(r.text) for r in docs.collect()}
    clean = found = 0
    for r in P.op3_bilstm_pii(docs).collect():
        listed = P.listed(by[r.doc_id])
        assert r.base_sha256 == hashlib.sha256(listed.encode()).hexdigest()
        assert set(filter(None, listed.split(","))) <= set(r.spans.split(","))
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(s[2] == k for s in by[r.doc_id]) for k in P.KINDS]
        clean += not by[r.doc_id]
        found += not by[r.doc_id] and r.n_added > 0
    assert found <= 0.005 * clean


def test_awkward_rows(spark):
    got = P.op3_bilstm_pii(awkward(spark)).collect()
    assert len(got) == 13 and all(r.base_sha256 == hashlib.sha256(b"").hexdigest() and r.spans == "" for r in got)
    assert P.op3_bilstm_pii(empty(spark)).count() == 0


def _forms(rng):
    """One maker per form of an added span; none of their words are in the training text."""
    digits = lambda n: "".join(rng.choice("0123456789") for _ in range(n))
    name = lambda: (rng.choice(["john", "maria.lopez", "jane_doe", "k.schmidt99", "peter-pan"]), rng.choice(["mail", "company", "my-host", "uni7", "shop"]), rng.choice(["com", "org", "de", "fr"]))
    out = {}
    for at in (" (at) ", "(at)", " [at] ", "[at]", " at "):
        for dot in (".", " (dot) ", "[dot]", " [dot] ", " dot "):
            out[f"x{at}y{dot}z"] = lambda at=at, dot=dot: (lambda n: f"{n[0]}{at}{n[1]}{dot}{n[2]}")(name())
    for shape in ("ddd-ddd-dddd", "ddd.ddd.dddd", "(ddd) ddd-dddd", "(ddd) ddd dddd", "0049 ddd ddddddd", "0044 ddd ddd dddd"):
        out[shape] = lambda shape=shape: "".join(rng.choice("123456789") if c == "d" else c for c in shape)
    for sep in (".", "  "):
        def card(sep=sep):
            body = "4" + digits(14)
            number = next(body + str(c) for c in range(10) if P.luhn(body + str(c)))
            return sep.join(number[i: i + 4] for i in range(0, 16, 4))
        out[f"card by {sep!r}"] = card
    out["of 85 characters"] = lambda: "a" * 35 + " (at) " + "hosting-provider-of-mails [dot] example [dot] com"
    return out


def test_recall_by_form_and_look_alikes(spark):
    import random
    rng, net = random.Random(77), P.trained()
    docs = [r.text for r in table(spark, "documents", "sf0.01").where("length(text) between 300 and 3000").orderBy("doc_id").limit(300).collect()]

    def put(piece):
        text = rng.choice(docs)
        at = rng.choice([i for i, c in enumerate(text) if c == " "]) + 1
        return text[:at] + piece + text[at - 1:], at, at + len(piece)

    recall = {}
    for form, make in _forms(rng).items():
        hits = 0
        for _ in range(40):
            text, a, z = put(make())
            base, added = P.find_spans(text, net)
            hits += any((x, y) == (a, z) for x, y, _ in base + added)
        recall[form] = hits / 40
    assert min(recall.values()) >= 0.8 and sum(recall.values()) / len(recall) >= 0.95, recall
    digits = lambda n: "".join(rng.choice("0123456789") for _ in range(n))
    wrong = 0
    for make in (lambda: " ".join(digits(3) for _ in range(4)), lambda: "00 11 22 33 44 55", lambda: f"20{digits(2)}-11-2{digits(1)}", lambda: f"978-3-16-{digits(6)}-0",
                 lambda: "look at him. Then", lambda: "met at noon.Then", lambda: digits(10), lambda: f"{digits(4)}-{digits(4)}", lambda: "the dot product", lambda: f"{digits(3)}.{digits(3)}.{digits(3)}"):
        for _ in range(40):
            text, a, z = put(make())
            wrong += any(x < z and y > a for x, y, _ in P.find_spans(text, net)[1])
    assert wrong <= 2


def test_every_form_holds_a_trigger_and_short_texts_are_scanned():
    import random
    for make in _forms(random.Random(3)).values():
        for _ in range(20):
            piece = make()
            assert P.TRIGGER.search(piece) and P.TRIGGER_BYTES.search(piece.encode())
    net = P.trained()
    for text in ("", "7", "a@", "at", " at x.y", "call 575-041-1701 now"):
        P.find_spans(text, net)
    assert P.LONGEST <= P.WINDOW - P.STRIDE
