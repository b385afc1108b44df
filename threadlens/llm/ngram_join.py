"""Near-duplicate join: Jaccard similarity of word shingles by adaptive multi-match prefixes.

A document is the set of its 4-word shingles.  Shingles are ordered by how far
their count exceeds the ordinary (from a fixed-size count sketch over all
documents), then by hash.  With l matches required, a document's prefix is its
first n - ceil(t n) + l shingles: two documents of similarity t share at least
min(l_x, l_y) prefix shingles.  l is chosen per document by the estimated
cost: documents whose prefix holds widely shared shingles take a longer prefix
and require more matches before verification.

Finding the pairs.  Identical sets are one node.  Sets of similarity t differ
in d <= n (1 - t) / t shingles, and each breaks one pair of neighbours at
most, so with their first d + 2 shared shingles they share a pair that is
adjacent in the order of both.  A node's keys are the adjacent pairs of that
longer prefix: two matches at once, which chance and shared phrases rarely
give.  Keys are sorted by range, so a key that most nodes hold is split over
tasks; each run of a key links its nodes to its first one, and runs that cross
tasks meet in a table of two rows a task.  These edges are as many as keys,
never pairs of nodes; their connected components are the groups.

A group is one task up to a fixed size; a larger one is cut by size class
(similar sets differ by one class at most) and hash into blocks, and every
pair of blocks that may link is a task.  In a task prefix matches are counted
by matrix products over shared shingles, candidates are verified exactly on
whole sets, and only links per node and a spanning forest leave it.  No pair
of nodes is emitted, dropped or capped.

Defined cases: a null or empty text has no set, links with nothing and is its
own component; a text of fewer than four words is one shingle; rows of one
doc_id are one document, linked through any of their texts (each distinct set is
compared, and the sets of one doc_id are joined); rows with a null
doc_id link with nothing and have a null component, unless their set equals
that of a document with an id; an empty table gives an empty result; extra
columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from threadlens.llm import words as W
from threadlens.llm.components import components
from threadlens.llm.shared import ship, written

#: Words of a shingle; least similarity in hundredths.
K, PERCENT = 4, 85
#: Buckets of the count sketch: its size doesn't follow the corpus.
SKETCH_BITS = 20
#: Matches that may be required, and the cost of a candidate in postings.
MATCHES, CANDIDATE_COST = (1, 2, 4, 8, 16), 4.0
#: Nodes and shingles of a block (a larger document is a block of its own).
BLOCK_NODES, BLOCK_SHINGLES = 1500, 3_000_000
#: Cells of a matrix that is multiplied at once.
CELLS = 4_000_000


def doc_sets(column: pa.Array, k: int) -> Iterator[np.ndarray]:
    """Sorted distinct shingle hashes of every text."""
    data, offsets = W.buffers(column)
    for lo, hi in W.slices(offsets):
        found = W.find_words(data[offsets[lo]: offsets[hi]], offsets[lo: hi + 1] - offsets[lo], lower=True)
        for i in range(hi - lo):
            yield np.unique(W.shingles(found.of(i), k))


def sketch_counts(docs: DataFrame, k: int = K) -> np.ndarray:
    """Shingles (with repeats) per hash bucket over all documents: a vector of fixed length."""
    ship(docs.sparkSession)
    size = 1 << SKETCH_BITS

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size, np.int64)
        for batch in batches:
            data, offsets = W.buffers(batch.column(0))
            for lo, hi in W.slices(offsets):
                found = W.find_words(data[offsets[lo]: offsets[hi]], offsets[lo: hi + 1] - offsets[lo], lower=True)
                h = W.shingles(found.hashes, k)
                if len(h) < len(found.hashes) - k + 1 or len(found.hashes) < k:
                    continue
                crosses = np.zeros(len(found.hashes), bool)
                for back in range(1, k):
                    at = found.first[1:-1] - back
                    crosses[at[(at >= 0) & (at < len(crosses))]] = True
                total += np.bincount((h[~crosses[: len(h)]] >> np.uint64(64 - SKETCH_BITS)).astype(np.int64), minlength=size)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int64()), pa.array(total[at], pa.int64())], names=["bucket", "n"])

    rows = docs.select("text").mapInArrow(count, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n"))
    got = rows.toArrow()
    out = np.zeros(size, np.int64)
    out[got["bucket"].to_numpy()] = got["n"].to_numpy()
    return out


def excess_counts(counts: np.ndarray) -> np.ndarray:
    """How far each bucket exceeds the ordinary bucket: an estimate of its shingle's count, 0 for ordinary ones."""
    usual = float(np.median(counts))
    return np.maximum(counts - usual - 4 * math.sqrt(usual) - 4, 0)


def prefix(shingles: np.ndarray, excess: np.ndarray, percent: int = PERCENT) -> tuple[np.ndarray, int]:
    """(prefix shingles, matches required) of one set."""
    n = len(shingles)
    over = excess[(shingles >> np.uint64(64 - SKETCH_BITS)).astype(np.int64)]
    order = np.argsort(np.frexp(over)[1].astype(np.int8), kind="stable")
    need = -(-percent * n // 100)
    best, matches = None, 1
    if over[order[: n - need + 1]].any():
        found = np.cumsum(over[order])
        for m in MATCHES:
            if m > need:
                break
            length = n - need + m
            cost = length + found[length - 1] * CANDIDATE_COST / m
            if best is None or cost < best:
                best, matches = cost, m
    return shingles[order[: n - need + matches]], matches


def keys(shingles: np.ndarray, excess: np.ndarray, percent: int = PERCENT) -> np.ndarray:
    """Hashes of the neighbours in the prefix that holds a common pair with every similar set."""
    n = len(shingles)
    differ = n * (100 - percent) // percent
    if not differ:  # only equal sets are similar
        return shingles[:0]
    over = excess[(shingles >> np.uint64(64 - SKETCH_BITS)).astype(np.int64)]
    order = np.argsort(np.frexp(over)[1].astype(np.int8), kind="stable")
    head = shingles[order[: differ + 2 + n + -percent * n // 100]]
    return W.mix64(head[:-1] * np.uint64(0xD1342543DE82EF95) + head[1:])


def _signed(docs: DataFrame, excess, k: int, percent: int) -> DataFrame:
    """doc_id, n, two hashes of the set, and keys of every document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, a, b, heads = [], [], [], []
            for s in doc_sets(batch.column("text"), k):
                n.append(len(s))
                a.append(int(np.add.reduce(W.mix64(s)).view(np.int64)) if len(s) else 0)
                b.append(int(np.add.reduce(W.mix64(s ^ np.uint64(0xA5A5A5A55A5A5A5A))).view(np.int64)) if len(s) else 0)
                heads.append(keys(s, excess.value, percent).view(np.int64))
            ends = np.concatenate([[0], np.cumsum([len(h) for h in heads])]).astype(np.int32)
            flat = np.concatenate(heads) if heads else np.zeros(0, np.int64)
            yield pa.RecordBatch.from_arrays([
                batch.column("doc_id").cast(pa.int64()), pa.array(n, pa.int64()), pa.array(a, pa.int64()), pa.array(b, pa.int64()),
                pa.ListArray.from_arrays(pa.array(ends), pa.array(flat, pa.int64()))],
                names=["doc_id", "n", "a", "b", "keys"])

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, n long, a long, b long, keys array<long>")


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted (key, node) rows -> edges from each key's first node, and the first and last run of the task (edge false)."""
    key = first = None
    opened = False
    for batch in batches:
        k, x = batch.column(0).to_numpy(), batch.column(1).to_numpy()
        if not len(k):
            continue
        new = np.ones(len(k), bool)
        new[1:] = k[1:] != k[:-1]
        if opened and k[0] == key:
            new[0] = False
        begin = np.maximum.accumulate(np.where(new, np.arange(len(k)), -1))
        lead = np.where(begin < 0, first if opened else 0, x[begin])
        on = lead != x
        pairs = np.unique(np.column_stack([lead[on], x[on]]), axis=0)
        zero = np.zeros(len(pairs), np.int64)
        edges = [pairs[:, 0], pairs[:, 1], zero, np.ones(len(pairs), bool)]
        if not opened:
            edges = [np.append(e, v) for e, v in zip(edges, (lead[0], lead[0], k[0], False))]
            opened = True
        key, first = k[-1], lead[-1]
        yield pa.RecordBatch.from_arrays([pa.array(e) for e in edges], names=["a", "b", "key", "edge"])
    if opened:
        yield pa.RecordBatch.from_arrays([pa.array([first]), pa.array([first]), pa.array([key]), pa.array([False])], names=["a", "b", "key", "edge"])


def holders(signed: DataFrame) -> DataFrame:
    """Edges (a, b) that connect all nodes of each key."""
    def distinct(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            _, first = np.unique(np.column_stack([batch.column(0).to_numpy(), batch.column(1).to_numpy()]), axis=0, return_index=True)
            lists = batch.column(2).take(pa.array(first))
            owner = np.repeat(batch.column(0).to_numpy()[first], np.diff(lists.offsets.to_numpy()))
            yield pa.RecordBatch.from_arrays([lists.flatten(), pa.array(owner)], names=["key", "node"])

    rows = signed.where("n > 0 and size(keys) > 0").select("a", "b", "keys").mapInArrow(distinct, "key long, node long")
    ranged = rows.repartitionByRange("key", "node").sortWithinPartitions("key", "node")
    found = written(ranged.mapInArrow(_runs, "a long, b long, key long, edge boolean"), "jaccard-runs")
    ends = found.where("not edge").select("key", "a").distinct()
    met = ends.join(ends.groupBy("key").agg(F.min("a").alias("first")), "key").where("a <> first").select(F.col("first").alias("a"), F.col("a").alias("b"))
    return found.where("edge").select("a", "b").union(met)


def overlaps(sets: list[np.ndarray]) -> np.ndarray:
    """Sizes of all pairwise intersections of a bounded list of sets."""
    m = len(sets)
    out = np.zeros((m, m), np.int32)
    if not m:
        return out
    flat = np.concatenate(sets)
    owner = np.repeat(np.arange(m), [len(s) for s in sets])
    order = np.argsort(flat, kind="stable")
    flat, owner = flat[order], owner[order]
    new = np.ones(len(flat), bool)
    new[1:] = flat[1:] != flat[:-1]
    token = np.cumsum(new) - 1
    held = np.bincount(token)
    shared = held[token] > 1
    owner, token = owner[shared], token[shared]
    if not len(token):
        return out
    _, token = np.unique(token, return_inverse=True)
    step, width = max(CELLS // m, 1), int(token[-1]) + 1
    cuts = np.searchsorted(token, np.arange(0, width + step, step))
    total = np.zeros((m, m), np.float32)
    for c, (lo, hi) in enumerate(zip(cuts[:-1], cuts[1:])):
        own = np.unique(owner[lo:hi])
        row = np.searchsorted(own, owner[lo:hi])
        x = np.zeros((len(own), min(step, width - c * step)), np.float32)
        x[row, token[lo:hi] - c * step] = 1
        total[np.ix_(own, own)] += x @ x.T
        if (c + 1) % 64 == 0 or hi == len(token):  # whole numbers stay exact in float32
            out += np.rint(total).astype(np.int32)
            total[:] = 0
    return out


def links(sets: list[np.ndarray], heads: list[np.ndarray], need: np.ndarray, allowed: np.ndarray, percent: int = PERCENT) -> tuple[np.ndarray, np.ndarray]:
    """Index pairs i < j of similar sets: enough prefix matches first, then the whole sets."""
    n = np.array([len(s) for s in sets])
    least = np.minimum(need[:, None], need[None, :])
    maybe = np.triu(overlaps(heads) >= least, 1) & allowed
    short, long = np.minimum(n[:, None], n[None, :]), np.maximum(n[:, None], n[None, :])
    maybe &= 100 * short >= percent * long
    i, j = np.nonzero(maybe)
    if not len(i):
        return i, j
    used = np.unique(np.concatenate([i, j]))
    if len(i) <= 4 * len(used):
        both = np.array([len(np.intersect1d(sets[x], sets[y], assume_unique=True)) for x, y in zip(i, j)])
    else:
        counts = overlaps([sets[x] for x in used])
        both = counts[np.searchsorted(used, i), np.searchsorted(used, j)]
    same = 100 * both >= percent * (n[i] + n[j] - both)
    return i[same], j[same]


def forest(n: int, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Smallest index of each node's component."""
    root = list(range(n))

    def find(x: int) -> int:
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    for a, b in zip(i.tolist(), j.tolist()):
        a, b = find(a), find(b)
        if a != b:
            root[max(a, b)] = min(a, b)
    return np.array([find(x) for x in range(n)], np.int64)


def _tasks(nodes: DataFrame, percent: int = PERCENT) -> DataFrame:
    """(node, n, copies, group) -> one row per node and task: ``task`` and ``side`` (0 and 1 are compared with each other only, 2 with all)."""
    sizes = nodes.groupBy("group").agg(F.count("*").alias("g_nodes"), F.sum("n").alias("g_shingles"))
    whole = (F.col("g_nodes") <= BLOCK_NODES) & (F.col("g_shingles") <= BLOCK_SHINGLES)
    nodes = nodes.join(sizes, "group")
    one = nodes.where(whole).select("node", "n", "copies", F.concat_ws(":", F.col("group")).alias("task"), F.lit(2).alias("side"))
    # classes of ratio 1/t, found on whole numbers so that both sides agree (at t = 1 only equal sizes are similar: any ratio serves)
    ratio = math.log(100 / min(percent, 99))
    many = nodes.where(~whole).withColumn("cls", F.floor(F.log(F.col("n").cast("double")) / F.lit(ratio) + F.lit(1e-9)))
    cut = many.groupBy("group", "cls").agg(
        F.greatest(F.ceil(F.count("*") / BLOCK_NODES), F.ceil(F.sum("n") / BLOCK_SHINGLES)).cast("int").alias("blocks"))
    many = many.join(cut, ["group", "cls"]).withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
    up = cut.select("group", (F.col("cls") - 1).alias("cls"), F.col("blocks").alias("up"))
    down = cut.select("group", (F.col("cls") + 1).alias("cls"), F.col("blocks").alias("down"))
    many = many.join(up, ["group", "cls"], "left").join(down, ["group", "cls"], "left")

    def each(count: str, make):
        return F.when(F.col(count).isNull(), F.array().cast("array<struct<task:string,side:int>>")).otherwise(
            F.transform(F.sequence(F.lit(0), F.col(count) - 1), make))

    def key(*parts):
        return F.concat_ws(":", *[p.cast("string") for p in parts])

    group, cls, block = F.col("group"), F.col("cls"), F.col("block")
    own = each("blocks", lambda o: F.struct(
        key(group, cls, F.least(block, o), F.greatest(block, o)).alias("task"),
        F.when(block == o, 2).when(block < o, 0).otherwise(1).alias("side")))
    higher = each("up", lambda o: F.struct(key(group, cls, block, F.lit("up"), o).alias("task"), F.lit(0).alias("side")))
    lower = each("down", lambda o: F.struct(key(group, cls - 1, o, F.lit("up"), block).alias("task"), F.lit(1).alias("side")))
    split = many.select("node", "n", "copies", F.explode(F.concat(own, higher, lower)).alias("t")).select("node", "n", "copies", "t.task", "t.side")
    return one.unionByName(split)


def _compare(excess, k: int, percent: int):
    def run(table: pa.Table) -> pa.Table:
        table = table.combine_chunks()
        # rows of one doc_id are one document: each text is compared
        node, side, copies, size = (table[c].to_numpy() for c in ("node", "side", "copies", "n"))
        sets = list(doc_sets(table["text"], k))
        use = [x for x in range(len(sets)) if len(sets[x]) == size[x] > 0]
        node, side, copies, sets = node[use], side[use], copies[use], [sets[x] for x in use]
        got = [prefix(s, excess.value, percent) for s in sets]
        allowed = ((side[:, None] != side[None, :]) | (side[:, None] == 2)) & (node[:, None] != node[None, :])
        i, j = links(sets, [g[0] for g in got], np.array([g[1] for g in got], np.int64), allowed, percent)
        pairs = np.unique(np.sort(np.column_stack([node[i], node[j]]), axis=1), axis=0) if len(i) else np.zeros((0, 2), np.int64)
        ids, first = np.unique(node, return_index=True)
        weight = copies[first]
        a, b = np.searchsorted(ids, pairs[:, 0]), np.searchsorted(ids, pairs[:, 1])
        degree = np.bincount(a, weight[b], len(ids)) + np.bincount(b, weight[a], len(ids))
        root = ids[forest(len(ids), a, b)] if len(ids) else ids
        on = degree > 0
        return pa.table({"node": pa.array(ids[on], pa.int64()), "root": pa.array(root[on], pa.int64()), "links": pa.array(degree[on].astype(np.int64), pa.int64())})

    return run


def _same_id(signed: DataFrame, sets: DataFrame) -> DataFrame:
    """Edges (a, b) between the nodes of the sets of one doc_id."""
    one = F.struct("n", "a", "b")
    several = signed.where("n > 0 and doc_id is not null").groupBy("doc_id").agg(F.min(one).alias("lo"), F.max(one).alias("hi")).where("lo <> hi").select("doc_id")
    held = signed.where("n > 0").join(several, "doc_id", "left_semi").join(sets, ["n", "a", "b"]).select("doc_id", "node").distinct()
    least = held.groupBy("doc_id").agg(F.min("node").alias("least"))
    return held.join(least, "doc_id").where("node <> least").select(F.col("least").alias("a"), F.col("node").alias("b"))


def similar(docs: DataFrame, k: int = K, percent: int = PERCENT) -> DataFrame:
    """doc_id, n_shingles, component_id and n_links of every document."""
    spark = docs.sparkSession
    ship(spark)
    excess = spark.sparkContext.broadcast(excess_counts(sketch_counts(docs, k)).astype(np.float32))
    signed = written(_signed(docs, excess, k, percent), "jaccard-signed")
    sets = signed.where("n > 0").groupBy("n", "a", "b").agg(F.min("doc_id").alias("node"), F.count("*").alias("copies"))
    sets = written(sets, "jaccard-sets")
    groups = components(holders(signed))
    # a doc_id with several texts is a node once for each of its sets
    nodes = sets.where("node is not null").join(groups.select(F.col("node").alias("a"), F.col("component").alias("group")), "a").groupBy(
        "node", "group", "n").agg(F.max("copies").alias("copies"))
    tasks = _tasks(written(nodes, "jaccard-nodes"), percent)
    texts = docs.select(F.col("doc_id").alias("node"), "text").join(tasks, "node")
    found = texts.groupBy("task").applyInArrow(_compare(excess, k, percent), "node long, root long, links long")
    found = written(found, "jaccard-links")
    joined = components(found.select(F.col("root").alias("a"), F.col("node").alias("b")).union(_same_id(signed, sets)))
    degree = found.groupBy("node").agg(F.sum("links").alias("links"))
    classes = sets.join(degree, "node", "left").join(joined, "node", "left").select(
        "n", "a", "b", "node", F.coalesce("component", "node").alias("component"), (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"))
    out = signed.select("doc_id", "n", "a", "b").join(classes, ["n", "a", "b"], "left")
    return out.select("doc_id", F.col("n").alias("n_shingles"), F.coalesce("component", "doc_id").alias("component_id"), F.coalesce("n_links", F.lit(0)).alias("n_links"))


def op8_ngram_jaccard(docs: DataFrame) -> DataFrame:
    """The join with production parameters: similarity 0.85 over 4-word shingles."""
    return similar(docs)


def one_of_each(docs: DataFrame, k: int = K, percent: int = PERCENT) -> DataFrame:
    """One row of each class of near copies (of the smallest doc_id), with the columns of ``docs``.

    Documents without a set stay, one row a doc_id; rows with a null doc_id all stay.
    """
    rows = docs.select("doc_id", F.xxhash64("text").alias("_text"), F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"))
    kept = similar(docs, k, percent).where("n_shingles = 0 or doc_id = component_id").select("doc_id").distinct()
    named = rows.join(kept, "doc_id", "left_semi").groupBy("doc_id").agg(F.min_by("_row", "_text").alias("_row"))
    return named.select("_row.*").unionByName(rows.where("doc_id is null").select("_row.*"))
