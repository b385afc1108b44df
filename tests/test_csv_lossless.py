"""No cell of a CSV feed is lost: random headers, single- and multi-line (hypothesis)."""

import csv
import json
import os
import tempfile

import pytest
from hypothesis import HealthCheck, Phase, given, settings
from hypothesis import strategies as st

from threadlens.sources.csv_feed import read_feed
from threadlens.streaming import ingest

EXPECTED = ["thread_id", "user_id", "team"]
NAMES = st.sampled_from([*EXPECTED, "extra", "extra", "extra_2", "_file_path", "_line", "", "_c4"])
FILES = st.lists(st.tuples(st.lists(NAMES, min_size=1, max_size=9), st.lists(st.integers(1, 12), min_size=1, max_size=3)), min_size=1, max_size=3)


def write_files(folder, files):
    """Every cell is unique; returns the cells of each record, by its first cell."""
    records, n = [], 0
    for i, (names, widths) in enumerate(files):
        with open(os.path.join(folder, f"thread_teams_{i}.csv"), "w", newline="") as f:
            f.write(",".join(f'"{x}"' if x else "" for x in names) + "\n")
            out = csv.writer(f, lineterminator="\n")
            for w in widths:
                cells = [f"v{(n := n + 1)}" + (",q" if n % 5 == 0 else "") for _ in range(w)]
                out.writerow(cells)
                records.append((names, cells))
    return records


def check(rows, records):
    left = {tuple(cells): names for names, cells in records}
    assert len(rows) == len(records)
    for r in rows:
        rescued = json.loads(r._rescued_data) if r._rescued_data else {}
        line = rescued.get("_line")
        held = [r[c] for c in EXPECTED if r[c]] + [v for k, v in rescued.items() if v and (k != "_file_path") and k != "_line"]
        if line:
            held += next(csv.reader([line]))
        match = [c for c in left if set(c) <= set(held)]
        assert len(match) == 1, (r, left)
        names, cells = left.pop(match[0]), match[0]
        for name in EXPECTED:  # the first column of a name is bound
            at = names.index(name) if name in names else None
            assert r[name] == (cells[at] if at is not None and at < len(cells) else None)


@pytest.mark.parametrize("multi_line", [False, True, "split"])
@settings(max_examples=6, deadline=None, phases=[Phase.explicit, Phase.generate], suppress_health_check=list(HealthCheck))
@given(files=FILES)
def test_every_cell_lands_somewhere(spark, multi_line, files):
    folder = tempfile.mkdtemp(prefix="threadlens-lossless-")
    records = write_files(folder, files)
    check(read_feed(spark, f"{folder}/*.csv", EXPECTED, multi_line=multi_line).collect(), records)


@pytest.mark.parametrize("multi_line", [False, True, "split"])
def test_a_hundred_extra_columns(spark, scratch, multi_line):
    os.makedirs(f"{scratch}/raw")
    names = ["team", *[f"x{i}" for i in range(100)], "thread_id"]
    records = write_files(f"{scratch}/raw", [(names, [102, 103, 1]), (["thread_id"], [1, 30])])
    check(read_feed(spark, f"{scratch}/raw/*.csv", EXPECTED, multi_line=multi_line).collect(), records)
    ingest.ingest_csv(spark, f"{scratch}/raw/*.csv", EXPECTED, f"{scratch}/bronze", f"{scratch}/chk", multi_line=multi_line)
    check(ingest.read_table(spark, f"{scratch}/bronze").collect(), records)


def test_long_row_with_an_empty_cell_is_rescued(spark, scratch):
    os.makedirs(f"{scratch}/raw")
    with open(f"{scratch}/raw/a.csv", "w") as f:
        f.write("thread_id,user_id,team\nt1,,x,EXTRA\n")
    for multi_line in (False, True):
        r = read_feed(spark, f"{scratch}/raw/*.csv", EXPECTED, multi_line=multi_line).first()
        assert (r.thread_id, r.user_id, r.team) == ("t1", None, "x") and "EXTRA" in r._rescued_data
