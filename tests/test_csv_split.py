"""CSV records with quoted line breaks, read in splits: equal to a plain CSV parser, wherever the splits fall."""

import csv
import random

import pytest

from threadlens.sources import csv_split
from threadlens.sources.csv_feed import SOURCE_FILE, SOURCE_LINE, lines_of, read_feed
from threadlens.streaming import ingest

COLUMNS = ["id", "text", "note"]


def write_random(path, seed, n, end="\n"):
    """``n`` records with quotes, commas and line breaks of every kind in their cells."""
    rnd = random.Random(seed)
    pieces = ["a", "bc", ",", '"', '""', "\n", "\n\n", "x,\ny", '"\n"', "é", " ", "\r\n"]
    rows = []
    with open(path, "w", newline="", encoding="utf-8") as f:
        out = csv.writer(f, lineterminator=end, quoting=csv.QUOTE_ALL)
        out.writerow(COLUMNS)
        for i in range(n):
            long = rnd.random() < 0.03  # some records span several splits
            text = "z" + "".join(rnd.choices(pieces, k=rnd.randint(300, 900) if long else rnd.randint(0, 6))) + "z"
            rows.append((f"r{i}", text, rnd.choice(["p", "q\nq", 'say "no"'])))
            out.writerow(rows[-1])
    return rows


@pytest.fixture
def small_splits(spark):
    old = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    spark.conf.set("spark.sql.files.maxPartitionBytes", "512")
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    yield
    for k, v in old.items():
        spark.conf.set(k, v)


def got(df):
    return sorted((r.id, r.text, r.note) for r in df.collect())


@pytest.mark.parametrize("end", ["\n", "\r\n"])
def test_splits_give_the_records_of_a_plain_parser(spark, scratch, small_splits, end):
    import os

    os.makedirs(f"{scratch}/raw")
    rows = [row for k in range(3) for row in write_random(f"{scratch}/raw/f{k}.csv", k, 60, end)]
    lines = csv_split.lines_of(spark, f"{scratch}/raw/*.csv")
    assert lines.select("file_path", "block_start").distinct().count() >= 15
    feed = read_feed(spark, f"{scratch}/raw/*.csv", COLUMNS, multi_line="split")
    assert got(feed) == sorted(rows)
    assert feed.filter("_rescued_data IS NOT NULL").count() == 0
    # positions follow the order of the records in their file
    for r in feed.groupBy(SOURCE_FILE).agg({"id": "count"}).collect():
        ids = [int(x.id[1:]) for x in feed.filter(feed[SOURCE_FILE] == r[SOURCE_FILE]).orderBy(SOURCE_LINE).collect()]
        assert ids == list(range(60))


def test_stream_in_splits_equals_batch(spark, scratch, small_splits):
    import os

    os.makedirs(f"{scratch}/raw")
    rows = write_random(f"{scratch}/raw/f1.csv", 11, 40)
    ingest.ingest_csv(spark, f"{scratch}/raw/*.csv", COLUMNS, f"{scratch}/bronze", f"{scratch}/chk", multi_line="split")
    rows += write_random(f"{scratch}/raw/f2.csv", 12, 40)
    ingest.ingest_csv(spark, f"{scratch}/raw/*.csv", COLUMNS, f"{scratch}/bronze", f"{scratch}/chk", multi_line="split")
    assert got(ingest.read_table(spark, f"{scratch}/bronze")) == sorted(rows)


def test_headers_blank_lines_and_unclosed_quotes(spark, scratch):
    import os

    os.makedirs(f"{scratch}/raw")
    with open(f"{scratch}/raw/a.csv", "w", newline="") as f:
        f.write('"te\nxt","id","text",note\n"h","1","t\n1",n\n\n"h","2","t2",n\n')
    with open(f"{scratch}/raw/b.csv", "w", newline="") as f:
        f.write('id,text,note\n3,"open,x\n4,y,z\n')
    open(f"{scratch}/raw/c.csv", "w").close()
    df = read_feed(spark, f"{scratch}/raw/*.csv", COLUMNS, multi_line="split")
    assert [(r.id, r.text) for r in df.orderBy("id").collect()] == [("1", "t\n1"), ("2", "t2"), ("3", "open,x\n4,y,z")]


def test_lines_without_quotes_are_records(spark, scratch):
    import os

    os.makedirs(f"{scratch}/raw")
    with open(f"{scratch}/raw/a.csv", "w") as f:
        f.write("id,text,note\n" + "".join(f"{i},t{i},\n" for i in range(50)))
    path = f"{scratch}/raw/*.csv"
    assert got(read_feed(spark, path, COLUMNS, multi_line="split")) == got(read_feed(spark, path, COLUMNS))
    assert csv_split.records(lines_of(spark, path)).count() == 51


def test_lines_are_not_shuffled(spark, scratch, small_splits):
    import os

    os.makedirs(f"{scratch}/raw")
    write_random(f"{scratch}/raw/a.csv", 4, 60)
    plan = csv_split.records(csv_split.lines_of(spark, f"{scratch}/raw/*.csv"))._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan and "SortMergeJoin" not in plan
    assert "Exchange hashpartitioning" not in plan and "Exchange rangepartitioning" not in plan
