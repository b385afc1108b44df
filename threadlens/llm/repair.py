"""Repair of conversation structure by an auction algorithm for shortest paths.

A conversation's rows, in order, and the states of the pattern
``(s?(ua)+)?`` of role initials span a lattice: node (i, q) stands before row i
in state q, and an edit is an arc.  Keep (0, and 5 if the row is truncated),
Rerole to the role that the state asks for (1, likewise) and Delete (2) lead to
row i + 1; Insert (5) stays before row i; blank and duplicate rows can only be
deleted.  The cheapest path to an accepting state after the last row is found
by the auction algorithm: every node has a price, at first the least cost of
the rows that remain.  A path grows from the origin along arcs whose cost
equals the difference of prices, the one with the ASCII-least letter first; at
a node without such an arc the price is raised to the least cost of an arc plus
the price behind it, and the path shrinks by one arc.  Prices never exceed the
true distances, so on arrival the path is shortest; and as an edit's letter
fixes the state it leads to, taking the least letter at every node gives the
ASCII-least sequence.

Conversations are cut into chunks of CHUNK rows, so one of any length is spread
over tasks.  A full chunk's least costs from each state to each state (auctions
as well, origins of one destination sharing their prices) are chained from the
end to give the prices after every chunk; then every chunk is traced from all
four states it may be entered in, and a last pass over the rows in order picks
the trace and hashes the repaired rows.  A sha256 is sequential, so that pass
streams a conversation through one task, holding one batch of rows and the
audit string, which is one value of the result.

Rows: a null role or text is one space.  Rows of one turn are ordered by role,
then by a hash of the text.  A row's role counts by its initial; an empty role
has the initial of a space, which no pattern takes.

Defined cases: null conversation ids are a conversation of their own; all rows
of one conversation and turn are damaged alike; very long texts are streamed;
a conversation that damage empties keeps its row with zeros, an empty audit and
the hash of the empty text; an empty table gives an empty result; extra columns
are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from threadlens.llm.ranks import ranked
from threadlens.llm.shared import ship, written

CHUNK = 64
#: Sequences of codes whose traces a task remembers.
CACHE = 100_000

# Costs of the edits, white space, ends of sentences.
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 1, 2, 5, 5
SPACE = "\x20\x09\x0a\x0b\x0c\x0d"
ENDS = (".", "!", "?")

START, SYSTEM, USER, ASSISTANT = range(4)
STATES = range(4)
ACCEPTING = (START, ASSISTANT)
#: What a state takes next: initial -> state.
TAKES = ({"s": SYSTEM, "u": USER}, {"u": USER}, {"a": ASSISTANT}, {"u": USER})
#: The role that Rerole and Insert give in a state, and the state behind it.
ASKS = ((USER, "user"), (USER, "user"), (ASSISTANT, "assistant"), (USER, "user"))
#: States that can be reached from each state (SYSTEM from START only by keeping a row).
REACH = (STATES, (SYSTEM, USER, ASSISTANT), (USER, ASSISTANT), (USER, ASSISTANT))

# A row's code is a letter for its fault and its initial: s, u, a or another.
INITIALS = "sua "
FAULTS = ("", "blank", "duplicate", "truncated")
CODES = {chr(ord("a") + k): (INITIALS[k % 4], FAULTS[k // 4]) for k in range(16)}


def row_arcs(letter: str, state: int) -> list[tuple[str, int, int]]:
    """(edit, cost, state behind) of a row in a state, by edit."""
    initial, fault = CODES[letter]
    out = [("D", DELETE, state)]
    if fault not in ("blank", "duplicate"):
        more = TRUNCATED if fault == "truncated" else 0
        if initial in TAKES[state]:
            out.append(("K", KEEP + more, TAKES[state][initial]))
        out.append(("R", REROLE + more, ASKS[state][0]))
    return out


ARCS = {letter: [row_arcs(letter, q) for q in STATES] for letter in CODES}
OPENS = {letter for letter, by in ARCS.items() if any(state == SYSTEM and edit == "K" for edit, _, state in by[START])}
LEAST = {letter: min(cost for arcs in by for _, cost, _ in arcs) for letter, by in ARCS.items()}


class Auction:
    """Prices of one chunk's lattice towards ``goal``: costs from each state after its last row (None: no way)."""

    def __init__(self, codes: str, goal: list[int | None]):
        self.codes, self.goal, self.n = codes, goal, len(codes)
        least = min(g for g in goal if g is not None)
        self.prices = [least] * (4 * (self.n + 1))
        for i in range(self.n - 1, -1, -1):
            least += LEAST[codes[i]]
            self.prices[4 * i: 4 * i + 4] = [least] * 4

    def best(self, node: int) -> tuple[int, str, int]:
        """(cost and price behind, edit, node behind) of the best arc, of equal ones the least letter."""
        i, q = divmod(node, 4)
        prices = self.prices
        to = 4 * i + ASKS[q][0]
        out = (INSERT + prices[to], "I", to)
        if i == self.n:
            return out if self.goal[q] is None else min(out, (self.goal[q], "", -1))
        base = 4 * i + 4
        return min(out, min((cost + prices[base + s], edit, base + s) for edit, cost, s in ARCS[self.codes[i]][q]))

    def run(self, state: int) -> tuple[int, str, int]:
        """(cost, edits, state after the last row) of the cheapest way from a state, ties ASCII-least."""
        prices = self.prices
        path, edits, node = [], [], state
        while True:
            value, edit, to = self.best(node)
            if prices[node] < value:
                prices[node] = value
                if path:
                    node = path.pop()
                    edits.pop()
            elif to < 0:
                return prices[state], "".join(edits), node - 4 * self.n
            else:
                path.append(node)
                edits.append(edit)
                node = to


def between(codes: str) -> list[int | None]:
    """Least costs of a chunk from state to state, flat; None where there is no way."""
    out: list[int | None] = [None] * 16
    for exit in STATES:
        auction = Auction(codes, [0 if q == exit else None for q in STATES])
        for entry in STATES:
            if exit in REACH[entry] and not (entry == START and exit == SYSTEM and OPENS.isdisjoint(codes)):
                out[4 * entry + exit] = auction.run(entry)[0]
    return out


END = [0 if q in ACCEPTING else None for q in STATES]


def chained(costs: list[int | None], goal: list[int | None]) -> list[int]:
    """The costs to the end before a chunk, from those after it."""
    return [min(c + g for c, g in zip(costs[4 * q: 4 * q + 4], goal) if c is not None and g is not None) for q in STATES]


def damaged(conversations: DataFrame) -> DataFrame:
    """The rows after damage, by a hash of conversation and turn: dropped, emptied, without marks, repeated, or of role user."""
    blank = lambda c: F.coalesce(c.cast("string"), F.lit(" "))
    kind = F.crc32(F.concat(blank(F.col("conv_id")), F.lit(":"), blank(F.col("turn"))).cast("binary")) % 20
    rows = conversations.select("conv_id", "turn", blank(F.col("role")).alias("role"), blank(F.col("text")).alias("text"), kind.alias("_kind")).where("_kind <> 0")
    text = F.when(F.col("_kind") == 1, F.lit("")).when(F.col("_kind") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    role = F.when(F.col("_kind") == 4, F.lit("user")).otherwise(F.col("role"))
    copies = F.array_repeat(F.lit(0), F.when(F.col("_kind") == 3, F.lit(2)).otherwise(F.lit(1)))
    return rows.select("conv_id", "turn", role.alias("role"), text.alias("text"), F.explode(copies).alias("_copy")).drop("_copy")


def group_of(conv_id: str = "conv_id") -> Column:
    return F.coalesce(F.concat(F.lit("="), F.col(conv_id).cast("string")), F.lit(""))


def coded(rows: DataFrame) -> DataFrame:
    """(grp, pos, role, text) -> (grp, chunk, codes): one letter a row, by place."""
    last = F.right(F.expr(f"trim(TRAILING '{SPACE}' FROM text)"), F.lit(1))
    named = F.concat(F.octet_length("role").cast("string"), F.lit(":"), "role", "text")
    narrow = rows.select("grp", "pos", F.substring("role", 1, 1).alias("initial"), last.alias("last"), F.unhex(F.sha2(named.cast("binary"), 256)).alias("same"))
    # only rows that occur again have an entry, the first of each
    firsts = narrow.groupBy("grp", "same").agg(F.min("pos").alias("first"), F.count("*").alias("n")).where("n > 1").select("grp", "same", "first")
    narrow = narrow.join(firsts, ["grp", "same"], "left")
    fault = F.when(F.col("last") == "", 1).when(F.col("pos") > F.col("first"), 2).when(F.col("last").isin(*ENDS), 0).otherwise(3)
    initial = F.when(F.col("initial").isin("s", "u", "a"), F.instr(F.lit(INITIALS), F.col("initial")) - 1).otherwise(3)
    letter = F.char(F.lit(ord("a")) + fault * 4 + initial)
    in_order = F.array_sort(F.collect_list(F.struct("pos", letter.alias("letter"))))
    return narrow.groupBy("grp", F.expr(f"pos div {CHUNK} AS chunk")).agg(F.array_join(in_order["letter"], "").alias("codes"))


def priced(chunks: DataFrame) -> DataFrame:
    """(grp, chunk, codes) -> also ``goal``, the least costs from each state after the chunk to the end."""

    def costs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            # a chunk that is the first and not full is the whole conversation
            found = [between(c) if k or len(c) == CHUNK else None for k, c in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist())]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(found, pa.list_(pa.int64()))], names=["grp", "chunk", "codes", "costs"])

    def chain(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, goal = None, END
        for batch in batches:
            goals = []
            for grp, found in zip(batch.column(0).to_pylist(), batch.column(3).to_pylist()):
                if grp != last:
                    last, goal = grp, END
                goals.append(goal)
                goal = chained(found, goal) if found else goal
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(goals, pa.list_(pa.int64()))], names=["grp", "chunk", "codes", "goal"])

    kinds = "grp string, chunk long, codes string, "
    with_costs = chunks.select("grp", "chunk", "codes").mapInArrow(costs, kinds + "costs array<long>")
    backwards = with_costs.repartition("grp").sortWithinPartitions("grp", F.col("chunk").desc())
    return backwards.mapInArrow(chain, kinds + "goal array<long>")


def traced(chunks: DataFrame) -> DataFrame:
    """(grp, chunk, codes, goal) -> (grp, chunk, codes, audits, exits): the edits and the state behind, for each state before."""

    def trace(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[tuple, tuple] = {}
        for batch in batches:
            audits, exits = [], []
            for chunk, codes, goal in zip(*[batch.column(k).to_pylist() for k in (1, 2, 3)]):
                key = (codes, chunk == 0, *goal)
                if key not in known:
                    auction = Auction(codes, goal)
                    ways = [auction.run(q) for q in (STATES if chunk else [START])]
                    if len(known) >= CACHE:
                        known.clear()
                    known[key] = [w[1] for w in ways], [w[2] for w in ways]
                audits.append(known[key][0])
                exits.append(known[key][1])
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:3], pa.array(audits, pa.list_(pa.string())), pa.array(exits, pa.list_(pa.int32()))],
                names=["grp", "chunk", "codes", "audits", "exits"])

    return chunks.repartition("grp", "chunk").mapInArrow(trace, "grp string, chunk long, codes string, audits array<string>, exits array<int>")


REPAIRED = "grp string, conv_id {}, turn {}, edit string, cost long, before string, fault string, role string, text string"


def _batch(rows: list[tuple], kind: pa.Schema) -> pa.RecordBatch:
    columns = zip(*rows) if rows else [()] * len(kind)
    return pa.RecordBatch.from_arrays([pa.array(list(c), f.type) for c, f in zip(columns, kind)], schema=kind)


class Editor:
    """Applies the chosen edits to the rows of a conversation as they stream by."""

    def __init__(self) -> None:
        self.state, self.codes, self.audit, self.exit, self.row, self.at = START, "", "", START, 0, 0

    def chunk(self, codes: str, audits: list[str], exits: list[int]) -> None:
        self.state = self.exit
        of = self.state if len(audits) > 1 else 0
        self.codes, self.audit, self.exit, self.row, self.at = codes, audits[of], exits[of], 0, 0

    def inserts(self) -> Iterator[tuple]:
        """The rows (edit, cost, initial before, fault, role) that are put in at this place."""
        while self.audit[self.at: self.at + 1] == "I":
            self.at += 1
            self.state, role = ASKS[self.state]
            yield "I", INSERT, None, None, role

    def edit(self, role: str) -> tuple:
        """What becomes of the next row; a deleted one has no role."""
        letter, edit = self.codes[self.row], self.audit[self.at]
        self.row, self.at = self.row + 1, self.at + 1
        initial, fault = CODES[letter]
        _, cost, behind = next(arc for arc in ARCS[letter][self.state] if arc[0] == edit)
        kept = {"D": None, "K": role, "R": ASKS[self.state][1]}[edit]
        self.state = behind
        return edit, cost, initial, fault, kept


def repair(rows: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text) -> the repair, one row an edit: REPAIRED, each conversation's in order within one partition.

    ``edit`` is K, R, D or I; ``before`` the initial of the row's role and
    ``fault`` its first fault; ``role`` and ``text`` are those of the repaired
    row (null if deleted).  Sound conversations come back as they were.
    """
    ship(rows.sparkSession)
    kinds = dict(rows.dtypes)
    grouped = rows.select(group_of().alias("grp"), "conv_id", "turn", "role", "text")
    placed = ranked(grouped, "grp", [F.col("turn").asc_nulls_first(), F.col("role"), F.xxhash64("text")], "repair-rows")
    chunks = written(priced(coded(placed)), "repair-chunks")
    pieces = traced(chunks).withColumn("pos", F.lit(-1).cast("long"))
    lines = placed.withColumn("chunk", F.expr(f"pos div {CHUNK}"))
    columns = ["grp", "chunk", "pos", "conv_id", "turn", "role", "text", "codes", "audits", "exits"]
    both = lines.unionByName(pieces, allowMissingColumns=True).select(columns)
    ordered = both.repartition("grp").sortWithinPartitions("grp", "chunk", "pos")
    names = [c.split()[0] for c in REPAIRED.split(", ")]
    arrow = {"cost": pa.int64(), **{c: to_arrow_type(both.schema[c].dataType) for c in ("conv_id", "turn")}}

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, conv, editor = None, None, Editor()
        kind = pa.schema([(n, arrow.get(n, pa.string())) for n in names])

        def put_in() -> list[tuple]:
            return [(last, conv, None, *new, "") for new in editor.inserts()]

        for batch in batches:
            out: list[tuple] = []
            for r in batch.to_pylist():
                if r["grp"] != last:
                    out += put_in()
                    last, editor = r["grp"], Editor()
                if r["codes"] is not None:
                    editor.chunk(r["codes"], r["audits"], r["exits"])
                    continue
                conv = r["conv_id"]
                out += put_in()
                done = editor.edit(r["role"])
                out.append((last, conv, r["turn"], *done, None if done[0] == "D" else r["text"]))
            yield _batch(out, kind)
        yield _batch(put_in(), kind)

    return ordered.mapInArrow(walk, REPAIRED.format(kinds["conv_id"], kinds["turn"]))


FIGURES = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")


class Summary:
    """Figures of one conversation, from its edits as they stream by."""

    def __init__(self, grp: str):
        self.grp, self.count = grp, dict.fromkeys(FIGURES, 0)
        self.first = self.turn = None
        self.turns, self.initial, self.audit, self.begun, self.hash = 0, None, [], False, hashlib.sha256()

    def add(self, r: dict) -> None:
        self.audit.append(r["edit"])
        self.count["cost"] += r["cost"]
        if r["edit"] != "I":
            if r["fault"]:
                self.count[r["fault"]] += 1
            if self.initial is not None and self.initial + r["before"] not in ("su", "ua", "au"):
                self.count["illegal"] += 1
            self.initial = r["before"]
            if r["turn"] is not None and r["turn"] != self.turn:
                self.first = r["turn"] if self.first is None else self.first
                self.turn, self.turns = r["turn"], self.turns + 1
        if r["edit"] != "D":
            self.hash.update((("\n" if self.begun else "") + r["role"] + ":" + r["text"]).encode())
            self.begun = True

    def row(self) -> tuple:
        if self.turns:
            self.count["gaps"] = self.turn - self.first + 1 - self.turns
        return self.grp, *[self.count[f] for f in FIGURES], "".join(self.audit), self.hash.hexdigest()


def summed(edits: DataFrame) -> DataFrame:
    """REPAIRED -> grp, FIGURES, audit and repaired_sha256 of every conversation with rows; reads each partition in order."""
    names = ["grp", *FIGURES, "audit", "repaired_sha256"]
    kind = pa.schema([(n, pa.int64() if n in FIGURES else pa.string()) for n in names])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current: Summary | None = None
        for batch in batches:
            out = []
            for r in batch.to_pylist():
                if current is None or r["grp"] != current.grp:
                    if current is not None:
                        out.append(current.row())
                    current = Summary(r["grp"])
                current.add(r)
            yield _batch(out, kind)
        yield _batch([current.row()] if current is not None else [], kind)

    return edits.mapInArrow(run, ", ".join(f"{n} {'long' if n in FIGURES else 'string'}" for n in names))


def op13_conversation_repair(conversations: DataFrame) -> DataFrame:
    """conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256 of every conversation."""
    figures = summed(repair(damaged(conversations)))
    every = conversations.select("conv_id", group_of().alias("grp")).distinct()
    empty = F.lit(hashlib.sha256(b"").hexdigest())
    return every.join(figures, "grp", "left").select(
        "conv_id", *[F.coalesce(f, F.lit(0).cast("long")).alias(f) for f in FIGURES],
        F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("repaired_sha256", empty).alias("repaired_sha256"))
