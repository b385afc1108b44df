import collections
import hashlib
import re
import zlib

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tests.llm.cases import table
from threadlens.llm import repair as R

WORD = re.compile(r"[^\x20\x09-\x0D]")
PATTERN = re.compile(r"(s?(ua)+)?")
SCHEMA = "conv_id long, turn long, role string, text string, cost string, codes string, grp string"


def cheapest(rows):
    """(cost, audit, repaired rows) by plain dynamic programming from the end: of equal costs the least rest of the audit."""
    step = {("", "s"): "s", ("", "u"): "u", ("s", "u"): "u", ("u", "a"): "a", ("a", "u"): "u"}
    asks = {"": "user", "s": "user", "u": "assistant", "a": "user"}
    after = {"": (0, "", None), "a": (0, "", None)}
    for i in range(len(rows), -1, -1):
        best = {}
        if i == len(rows):
            best = dict(after)
        else:
            role, text, fault = rows[i]
            for q in asks:
                ways = [(2, "D", q, None)]
                if fault not in ("blank", "duplicate"):
                    more = 5 * (fault == "truncated")
                    ways += [(more, "K", step[q, role[:1]], (role, text))] if (q, role[:1]) in step else []
                    ways += [(1 + more, "R", step[q, new[0]], (new, text)) for new in ("user", "assistant") if (q, new[0]) in step]
                found = [(c + after[to][0], e + after[to][1], (out, after[to][2])) for c, e, to, out in ways if to in after]
                if found:
                    best[q] = min(found, key=lambda w: w[:2])
        for _ in range(3):
            for q, role in asks.items():
                to = step[q, role[0]]
                if to in best:
                    way = (5 + best[to][0], "I" + best[to][1], ((role, ""), best[to][2]))
                    if q not in best or way[:2] < best[q][:2]:
                        best[q] = way
        after = best
    cost, audit, rest = after[""]
    out = []
    while rest is not None:
        if rest[0] is not None:
            out.append(rest[0])
        rest = rest[1]
    return cost, audit, out


def damage(rows):
    out = collections.defaultdict(list)
    for r in rows:
        conv, turn, role, text = r[:4]
        out[conv]
        role, text = " " if role is None else role, " " if text is None else text
        kind = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        if kind == 0:
            continue
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        role = "user" if kind == 4 else role
        out[conv] += [(turn, role, text)] * (2 if kind == 3 else 1)
    return out


def brute(rows):
    out = {}
    for conv, got in damage(rows).items():
        got.sort(key=lambda r: (r[0] is not None, r[0] or 0))
        seen, judged, counts = set(), [], collections.Counter()
        for _, role, text in got:
            marks = WORD.findall(text)
            fault = "blank" if not marks else "duplicate" if (role, text) in seen else "truncated" if marks[-1] not in ".!?" else ""
            seen.add((role, text))
            counts[fault] += 1
            judged.append((role, text, fault))
        illegal = sum(a[0][:1] + b[0][:1] not in ("su", "ua", "au") for a, b in zip(judged, judged[1:]))
        turns = [r[0] for r in got if r[0] is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        cost, audit, repaired = cheapest(judged)
        assert PATTERN.fullmatch("".join(r[0][:1] for r in repaired))
        sha = hashlib.sha256("\n".join(f"{a}:{b}" for a, b in repaired).encode()).hexdigest()
        out[conv] = (conv, gaps, counts["blank"], counts["duplicate"], counts["truncated"], illegal, cost, audit, sha)
    return out


COLUMNS = ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]


def same(df, rows):
    assert df.columns == COLUMNS
    got = {r.conv_id: tuple(r) for r in df.collect()}
    assert got == brute(rows)


@pytest.mark.parametrize("sf", ["sf0.01", "sf0.1"])
def test_given_conversations_equal_brute_force(spark, sf):
    conversations = table(spark, "conversations", sf)
    same(R.op13_conversation_repair(conversations), [tuple(r) for r in conversations.select("conv_id", "turn", "role", "text").collect()])


@settings(max_examples=400, deadline=None)
@given(st.lists(st.sampled_from(sorted(R.CODES)), max_size=14))
def test_auction_equals_dynamic_programming(codes):
    names = {"s": "system", "u": "user", "a": "assistant", " ": "tool"}
    rows = [(names[R.CODES[c][0]], "t", R.CODES[c][1]) for c in codes]
    cost, audit, exit = R.Auction("".join(codes), R.END).run(R.START)
    assert (cost, audit) == cheapest(rows)[:2] and exit in R.ACCEPTING


@settings(max_examples=150, deadline=None)
@given(st.lists(st.sampled_from(sorted(R.CODES)), min_size=1, max_size=20), st.integers(1, 19))
def test_chunks_chain_to_the_same_way(codes, cut):
    codes = "".join(codes)
    a, b = codes[:cut], codes[cut:]
    goal = R.chained(R.between(b), R.END) if b else R.END
    cost, audit, state = R.Auction(a, goal).run(R.START)
    if b:
        audit += R.Auction(b, R.END).run(state)[1]
    assert (cost, audit) == R.Auction(codes, R.END).run(R.START)[:2]


def made(n, conv, rng):
    roles = ["user", "assistant", "system", "tool", "", "User", None]
    texts = ["Hello there.", "What now?", "cut off", "", "  \n", None, "Fine!  ", "é ok."]
    return [(conv, t, rng.choice(roles if rng.random() < 0.3 else roles[:2]), f"{rng.choice(texts) or ''} {t}." if rng.random() < 0.6 else rng.choice(texts), "x", "y", "z") for t in range(n)]


def test_a_conversation_over_many_chunks_beside_others(spark):
    import random
    rng = random.Random(4)
    rows = made(2500, 1, rng) + made(R.CHUNK, 2, rng) + made(R.CHUNK * 2, 3, rng) + [r for c in range(4, 40) for r in made(rng.randint(1, 9), c, rng)]
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, SCHEMA).repartition(6)
    same(R.op13_conversation_repair(df), rows)


def test_awkward_and_empty_tables(spark):
    rows = [(None, None, None, None, "x", "y", "z"), (None, 1, "user", "Hi.", "x", "y", "z"), (5, None, "user", "A?", "x", "y", "z"),
            (6, 3, "assistant", "w " * 60_000 + ".", "x", "y", "z"), (6, 9, "user", "q?", "x", "y", "z")]
    rows += [(c, 0, "user", "Only.", "x", "y", "z") for c in range(100, 160)]  # some lose their only row
    df = spark.createDataFrame(rows, SCHEMA)
    same(R.op13_conversation_repair(df), rows)
    gone = [r for r in R.op13_conversation_repair(df).collect() if r.audit == ""]
    assert gone and all(r.repaired_sha256 == hashlib.sha256(b"").hexdigest() and r.cost == 0 for r in gone)
    assert R.op13_conversation_repair(df.limit(0)).count() == 0


def test_repeated_rows_of_one_turn_are_duplicates(spark):
    rows = [(c, t, "user" if t % 2 == 0 else "assistant", f"Line {t}.", "", "", "") for c in range(30) for t in (0, 1, 1, 2, 3)]
    same(R.op13_conversation_repair(spark.createDataFrame(rows, SCHEMA)), rows)


def test_repair_gives_the_rows(spark):
    rows = [(1, 0, "user", "Hi."), (1, 1, "user", "Hello?"), (1, 2, "assistant", "Yes.")]
    got = R.repair(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")).collect()
    assert [(r.edit, r.role, r.text, r.cost) for r in got] == [("D", None, None, 2), ("K", "user", "Hello?", 0), ("K", "assistant", "Yes.", 0)]
