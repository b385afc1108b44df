"""By-name CSV binding against Python's csv module on random files (hypothesis)."""

import csv
import json
import os
import tempfile

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from threadlens.sources.csv_feed import read_feed

EXPECTED = ["thread_id", "user_id", "team"]
cell = st.text(alphabet=st.sampled_from(list('ab ,"x1é')), min_size=1, max_size=6).filter(
    lambda v: v.strip() == v)  # values without surrounding blanks
file_spec = st.tuples(
    st.permutations(EXPECTED + ["extra"]),
    st.integers(0, 2),                         # how many of the 4 columns to drop
    st.lists(st.lists(cell, min_size=4, max_size=4), min_size=1, max_size=4),
)


@settings(max_examples=10, deadline=None, suppress_health_check=list(HealthCheck))
@given(files=st.lists(file_spec, min_size=1, max_size=3))
def test_binding_matches_csv_module(spark, files):
    d = tempfile.mkdtemp(prefix="threadlens-csvprop-")
    want = []
    for i, (cols, drop, rows) in enumerate(files):
        cols = list(cols)[: 4 - drop]
        with open(os.path.join(d, f"thread_teams_{i}.csv"), "w", newline="") as f:
            w = csv.writer(f, quoting=csv.QUOTE_MINIMAL, doublequote=True)
            w.writerow(cols)
            for r in rows:
                values = dict(zip(cols, r))
                w.writerow([values[c] for c in cols])
                want.append((tuple(values.get(c) for c in EXPECTED),
                             {"extra": values["extra"]} if "extra" in cols else None))
    got = []
    for r in read_feed(spark, f"{d}/*.csv", EXPECTED).collect():
        rescued = json.loads(r._rescued_data) if r._rescued_data else None
        if rescued:
            rescued.pop("_file_path")
        got.append((tuple(r[c] for c in EXPECTED), rescued))
    key = lambda x: (repr(x[0]), repr(x[1]))
    assert sorted(got, key=key) == sorted(want, key=key)
