import re

import pytest

from tests.llm.cases import PROSE, SCHEMA, awkward, empty, row, table
from threadlens.llm import licenses as L


def brute(text, percent=80):
    plain = re.sub(r"[^\w\n]+|_", " ", (text or "").lower())
    units = plain.split("\n") + [p for p in re.split(r"\n *\n", plain) if "\n" in p] + [plain]
    found = []
    for unit in {" ".join(u.split()) for u in units}:
        words = unit.split()
        own = L.Counter(f"{a} {b}" for a, b in zip(words, words[1:]))
        for name, grams in L.template_grams():
            total = sum(own.values()) + sum(grams.values())
            dice = 2 * sum((own & grams).values()) / total if own else 0
            if dice * 100 >= percent:
                found.append((name, dice))
    return found


def test_lines_paragraphs_and_altered_notices(spark):
    mit = L.TEMPLATES[2][1]
    wrapped = re.sub(r"(.{60}\S*) ", r"\1\n", mit)
    texts = ["Released under the MIT License.", f"{PROSE}\nreleased under THE mit licence!\n{PROSE}", f"{PROSE}\n\n{wrapped}\n\n{PROSE}", wrapped, wrapped.replace("free of charge", "gratis"),
             mit + " " + PROSE * 4, "All rights reserved", "All rights", "Licensed under CC BY-NC 4.0.\nLicensed under CC BY-NC 4.0.", "Licensed under CC BY 4.0", PROSE,
             "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance."]
    docs = spark.createDataFrame([row(i, t) for i, t in enumerate(texts)], SCHEMA)
    hits = 0
    for r in L.op6_license_dice(docs).collect():
        want = brute(texts[r.doc_id])
        assert r.n_matches == len(want), texts[r.doc_id]
        assert r.licenses == ",".join(sorted({n for n, _ in want}))
        assert r.dice == pytest.approx(max((d for _, d in want), default=0), abs=1e-6)
        hits += bool(want)
    assert hits >= 8


LINES = {
    "This work is licensed under the GNU General Public License, version 3.": "GPL", "Released under the MIT License.": "MIT", "All rights reserved.": "Proprietary",
    "Licensed under CC BY-NC 4.0.": "CC-BY-NC-4.0", "Licensed under the Apache License, Version 2.0.": "Apache-2.0",
}


def test_every_licence_line_of_the_documents_is_found(spark):
    docs = table(spark, "documents", "sf0.1")
    lines = {r.doc_id: {x.strip() for x in r.text.split("\n") if re.search("licen[sc]|rights reserved|copyright", x, re.I)} for r in docs.where("text is not null").collect()}
    assert {x for own in lines.values() for x in own} == set(LINES)
    for r in L.op6_license_dice(docs.repartition(16)).collect():
        assert r.licenses == ",".join(sorted(LINES[x] for x in lines.get(r.doc_id, ()))), r.doc_id


@pytest.mark.parametrize("before", ["Licensed", "This work is licensed", "This software is licensed"])
def test_short_notices_are_found(spark, before):
    names = {"GNU General Public License, version 2": "GPL", "GNU General Public License, version 3": "GPL", "GNU Lesser General Public License, version 2.1": "LGPL",
             "GNU Lesser General Public License, version 3": "LGPL", "GNU Affero General Public License, version 3": "AGPL", "Mozilla Public License, version 2.0": "MPL-2.0",
             "BSD License": "BSD", "BSD 2-Clause License": "BSD", "BSD 3-Clause License": "BSD", "ISC License": "ISC"}
    texts = [f"{before} under the {name}." for name in names]
    docs = spark.createDataFrame([row(i, f"{PROSE}\n{t}\n{PROSE}") for i, t in enumerate(texts)], SCHEMA)
    for r in L.op6_license_dice(docs).collect():
        want = list(names.values())[r.doc_id]
        assert want in r.licenses.split(","), texts[r.doc_id]
        if before != "Licensed":  # one word apart of few: the GPL's shortest notices are similar to each other's
            assert r.licenses == want


def test_size_bounds_lose_no_match():
    for t in (50, 80, 95):
        for b in range(1, 40):
            for a in range(1, 80):
                if 2 * min(a, b) * 100 >= t * (a + b):
                    assert a * (200 - t) >= t * b and a * t <= (200 - t) * b


def test_awkward_rows(spark):
    got = L.op6_license_dice(awkward(spark)).collect()
    assert len(got) == 13 and all(tuple(r)[1:] == (0, "", 0.0) for r in got)
    assert L.op6_license_dice(empty(spark)).count() == 0


@pytest.mark.parametrize("percent", [60, 80, 95])
def test_every_similar_unit_holds_an_anchor_word(percent):
    anchors = set(L.anchor_words(percent))
    for _, grams in L.template_grams():
        size = sum(grams.values())
        free = sum(k for g, k in grams.items() if not set(g.split()) & anchors)
        # with no anchor at most `free` bigrams can be shared, too few for any unit size
        assert free * (200 - percent) < percent * size
