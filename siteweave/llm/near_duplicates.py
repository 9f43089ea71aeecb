"""Near-duplicate documents by a chosen-path set similarity join.

A document is the set of its word shingles (64-bit hashes of runs of `width` lower-cased words). Documents of equal sets
form a class at once; the join runs over one representative of each.

Each set has a signature of POSITIONS minwise tokens. A tree of the join starts with all sets in its root; a set goes on
to the child (position, token) if a hash of the path so far and the token falls below 1 / (threshold * POSITIONS), so that
two sets at the threshold share one child of a shared node on average. Branching goes on for as many levels as unrelated
sets need to part (measured on a bounded sample of signatures, so nodes stay small as the table grows); what is still
together then is alike. Independent trees are added until the chance that some tree keeps a pair at the threshold together
reaches the target recall.

The sets of a node are compared exhaustively on sketches of two bits a position, packed into four numbers. A node gives one
row a set: the smallest id that such pairs lead to. Nodes beyond NODE sets are held against their smallest id first, and
what that leaves open meets the node in blocks. The rows' components are groups that no link leaves, small on the whole.
A group's texts are brought together once, and all its pairs are compared on the full sets: in one task up to GROUP texts;
beyond that each text is held against PIVOTS of the group, and those that aren't in the group's main component yet meet
the whole group in blocks of GROUP by GROUP texts. No list of pairs is made at any point, so what is shuffled follows the
number of documents, however many of them are alike.

Null, empty and blank texts have an empty set and link with nothing. A text with fewer words than a shingle is one shingle of
all its words. Texts are taken whole. Rows are told apart by their id, a whole number or a text of one (other texts raise an
error); rows that repeat an id count as one document with the text that sorts first. Null ids take no part. Other columns,
whatever their names, are ignored by classes() and kept by deduplicate().
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siteweave.llm.common import LOWER, kept, mix, pieces, remove, table, utf8, word_bounds, written
from siteweave.llm.components import components

POSITIONS = 128
THRESHOLD = 0.8
TARGET_RECALL = 0.9999
#: Sets of a node that one task compares; larger nodes go in blocks.
NODE = 2_048
#: Unrelated sets that a set may meet in a node: comparing so many sketches costs about as much as placing the set once more.
MATES = 32
#: Texts of a group that one task compares, and texts that those of a larger group are held against first.
GROUP, PIVOTS = 512, 16
#: Nodes beyond NODE whose list is sent to all tasks; a longer list is joined by shuffling.
LISTED = 100_000
#: Signatures by which the levels are chosen.
SAMPLED = 1_000
_EMPTY = np.uint64(0xFFFFFFFFFFFFFFFF)
_SEEDS = mix(np.arange(1, POSITIONS + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
_STEP = np.uint64(0x100000001B3)


def _powers(n: int, base: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        out = np.full(n, base, dtype=np.uint64)
        out[:1] = 1
        return np.cumprod(out, dtype=np.uint64)


_BASE = 0x9E3779B97F4A7C15 | 1
_BYTE = mix(np.arange(256, dtype=np.uint64) + np.uint64(77))


def shingle_sets(column: pa.Array, width: int) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of each text."""
    raw, offsets = utf8(column)
    raw = LOWER[raw]
    starts, ends, counts = word_bounds(raw, offsets)
    if not len(starts):
        return [np.empty(0, np.uint64)] * len(column)
    with np.errstate(over="ignore"):
        # A word's hash is the polynomial of its bytes: a difference of running sums over a power of the base.
        run = np.concatenate([np.zeros(1, np.uint64), np.cumsum(_BYTE[raw] * _powers(len(raw), _BASE), dtype=np.uint64)])
        inverse = _powers(len(raw), pow(_BASE, -1, 1 << 64))
        words = mix((run[ends] - run[starts]) * inverse[starts] + (ends - starts).astype(np.uint64) * _STEP)
        whole = len(words) - width + 1
        out = [np.empty(0, np.uint64)] * len(counts)
        first = np.concatenate([[0], np.cumsum(counts)])
        if whole > 0:
            shingles = np.zeros(whole, np.uint64)
            for k in range(width):
                shingles = mix(shingles * _STEP + words[k : k + whole])
        for r in range(len(counts)):
            a, b = first[r], first[r + 1]
            if b - a >= width:
                out[r] = np.unique(shingles[a : b - width + 1])
            elif b > a:
                h = np.uint64(b - a)
                for w in words[a:b]:
                    h = mix(np.array([h * _STEP + w], np.uint64))[0]
                out[r] = np.array([h], np.uint64)
    return out


def signature(shingles: np.ndarray) -> np.ndarray:
    """The minwise tokens of a set: by position, 16 bits of the smallest hash."""
    out = np.full(POSITIONS, _EMPTY)
    with np.errstate(over="ignore"):
        for at in range(0, len(shingles), 512):
            part = shingles[at : at + 512]
            # Multiply-shift families of the hashes; the hashes themselves are mixed well.
            h = (part[None, :] ^ _SEEDS[:, None]) * (_SEEDS[::-1, None] | np.uint64(1))
            h ^= h >> np.uint64(29)
            np.minimum(out, h.min(axis=1), out=out)
        return (mix(out) >> np.uint64(48)).astype(np.uint16)


def signatures(docs: DataFrame, width: int) -> DataFrame:
    """id, n (set size), print (a 128-bit fingerprint of the set as two numbers) and sig, for each row of docs (id, text)."""
    schema = "id long, n long, p1 long, p2 long, sig binary"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept("near_duplicates")
        for batch in pieces(batches, "text", 1 << 20):
            sets = shingle_sets(batch.column("text"), width)
            with np.errstate(over="ignore"):
                prints = [(int(s.sum(dtype=np.uint64).astype(np.int64)), int(mix(s).sum(dtype=np.uint64).astype(np.int64))) for s in sets]
            sigs = [signature(s).astype("<u2").tobytes() for s in sets]
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), pa.array([len(s) for s in sets], pa.int64()), pa.array([p for p, _ in prints], pa.int64()), pa.array([p for _, p in prints], pa.int64()), pa.array(sigs, pa.binary())],
                names=["id", "n", "p1", "p2", "sig"],
            )

    return docs.mapInArrow(run, schema)


def survival(level: int, mean: float = 1.0) -> float:
    """The chance that a pair whose sets share `mean` children of a shared node on average shares a node at this level."""
    p = 1.0
    for _ in range(level):
        p = 1 - math.exp(-mean * p)
    return p


def trees_for(level: int, recall: float) -> int:
    return max(1, math.ceil(math.log(1 - recall) / math.log(1 - survival(level))))


def levels_for(sample: np.ndarray, rows: int) -> int:
    """The levels after which a set shares a node with about MATES unrelated ones on average."""
    if len(sample) < 2:
        return 1
    agree = np.concatenate([(sample[k] == sample[k + 1 :]).mean(axis=1) for k in range(len(sample) - 1)])
    usual = agree[agree < 0.5]
    if not len(usual):
        return 2
    for level in range(2, 7):
        if rows * ((usual / THRESHOLD) ** level).mean() <= MATES:
            return level
    return 7


def _branch(sigs: np.ndarray, nodes: np.ndarray, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """The children of rows (signature, node): the row's number and the child node, by chosen tokens."""
    below = np.uint64(int(2**64 / (threshold * POSITIONS)) - 1)
    with np.errstate(over="ignore"):
        h = mix(mix(sigs.astype(np.uint64) ^ _SEEDS[None, :]) ^ nodes[:, None])
    row, _ = hit = np.nonzero(h < below)
    return row, mix(h[hit] + np.uint64(1))


def _sketch(sigs: np.ndarray) -> np.ndarray:
    """Two bits of each position, in four numbers a signature."""
    bits = (sigs & 3).astype(np.uint64).reshape(len(sigs), 4, POSITIONS // 4)
    return np.ascontiguousarray((bits << (2 * np.arange(POSITIONS // 4, dtype=np.uint64))).sum(axis=2, dtype=np.uint64).view(np.int64))


def most_apart(threshold: float) -> int:
    """Sketch positions in which a pair at the threshold can differ: 5 standard deviations beyond the mean."""
    apart = (1 - threshold) * 0.75
    return math.floor(POSITIONS * (apart + 5 * math.sqrt(apart * (1 - apart) / POSITIONS)))


_PLACED = "node long, id long, n long, s0 long, s1 long, s2 long, s3 long"
_ODD = 0x5555555555555555


def paths(sigs: DataFrame, levels: int, trees: int, threshold: float) -> DataFrame:
    """(node, id, n, sketch) of the nodes that each set reaches `levels` below the roots of the trees."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept("near_duplicates")
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                s = np.frombuffer(b"".join(part.column("sig").to_pylist()), "<u2").reshape(-1, POSITIONS)
                got_nodes, got_rows = [], []
                for t in range(trees):
                    nodes, row = np.full(len(s), mix(np.array([t + 1], np.uint64))[0]), np.arange(len(s))
                    for _ in range(levels):
                        child, nodes = _branch(s[row], nodes, threshold)
                        row = row[child]
                    got_nodes.append(nodes)
                    got_rows.append(row)
                row, sketch = np.concatenate(got_rows), _sketch(s)
                columns = [np.concatenate(got_nodes).view(np.int64), part.column("id").to_numpy()[row], part.column("n").to_numpy()[row], *(sketch[row, k] for k in range(4))]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["node", "id", "n", "s0", "s1", "s2", "s3"])

    return sigs.mapInArrow(run, _PLACED)


def heads_of(i: np.ndarray, j: np.ndarray, count: int) -> np.ndarray:
    """For each of `count` items the least one that the links i, j lead to."""
    head = np.arange(count)
    while len(i):
        a, b = head[i], head[j]
        open_ = a != b
        i, j, a, b = i[open_], j[open_], a[open_], b[open_]
        np.minimum.at(head, np.maximum(a, b), np.minimum(a, b))
        while (head[head] != head).any():
            head = head[head]
    return head


def _alike(n: np.ndarray, sketch: np.ndarray, i: np.ndarray, j: np.ndarray, threshold: float) -> np.ndarray:
    """Which pairs the sizes and sketches don't rule out."""
    apart = sketch[i] ^ sketch[j]
    apart = np.bitwise_count((apart | (apart >> np.uint64(1))) & np.uint64(_ODD)).sum(axis=1, dtype=np.int64)
    return (np.minimum(n[i], n[j]) >= threshold * np.maximum(n[i], n[j]) - 1e-9) & (apart <= most_apart(threshold))


def _sketches(rows: pa.Table) -> np.ndarray:
    return np.stack([rows.column(f"s{k}").to_numpy() for k in range(4)], axis=1).view(np.uint64)


def in_nodes(placed: DataFrame, threshold: float) -> DataFrame:
    """(a, b): each set with an alike one in its node, and the smallest id that alike pairs of the node lead to."""

    def compared(rows: pa.Table) -> pa.RecordBatch:
        node, ids, n, sketch = (rows.column("node").to_numpy(), rows.column("id").to_numpy(), rows.column("n").to_numpy(), _sketches(rows))
        pairs, live, step = [], np.arange(len(node)), 0
        while len(live):  # all pairs that are `step` rows apart
            step += 1
            live = live[: np.searchsorted(live, len(node) - step)]
            live = live[node[live] == node[live + step]]
            for at in range(0, len(live), 1 << 16):
                i = live[at : at + (1 << 16)]
                i = i[_alike(n, sketch, i, i + step, threshold)]
                pairs.append((i, i + step))
        i, j = (np.concatenate([p[k] for p in pairs]) if pairs else np.empty(0, np.int64) for k in (0, 1))
        head = heads_of(i, j, len(ids))
        other = np.flatnonzero(head != np.arange(len(ids)))
        return pa.RecordBatch.from_arrays([pa.array(ids[other]), pa.array(ids[head[other]])], names=["a", "b"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest = None
        for batch in batches:
            if not batch.num_rows:
                continue
            rows = pa.Table.from_batches([batch])
            rows = pa.concat_tables([rest, rows]).combine_chunks() if rest is not None else rows
            node = rows.column("node").to_numpy()
            whole = int(np.searchsorted(node, node[-1]))  # the last node may go on in the next batch
            rest = rows.slice(whole)
            if whole:
                yield compared(rows.slice(0, whole))
        if rest is not None:
            yield compared(rest)

    return placed.repartition("node").sortWithinPartitions("node", "id").mapInArrow(run, "a long, b long")


def dealt(rows: DataFrame, by: str, first, counts: DataFrame, most: int) -> DataFrame:
    """rows in blocks: those with the condition `first` as chunks of `most`, each with all chunks of the rows. Adds cx, cy and side.

    counts: by, k (rows) and f (rows with the condition). A row is in as many blocks as the other side has chunks.
    """
    known = rows.join(counts, by).withColumn("kx", F.ceil(F.col("f") / most)).withColumn("ky", F.ceil(F.col("k") / most)).where("f > 0")
    hashed = F.xxhash64("id", by)
    x = known.where(first).withColumn("cx", F.pmod(hashed, "kx")).withColumn("cy", F.explode(F.sequence(F.lit(0).cast("long"), F.col("ky") - 1))).withColumn("side", F.lit(0))
    y = known.withColumn("cy", F.pmod(hashed, "ky")).withColumn("cx", F.explode(F.sequence(F.lit(0).cast("long"), F.col("kx") - 1))).withColumn("side", F.lit(1))
    return x.unionByName(y.select(x.columns)).drop("k", "f", "kx", "ky")


def in_large_nodes(placed: DataFrame, threshold: float) -> DataFrame:
    """What in_nodes() gives, for nodes of any size: sets alike to the node's smallest id, and the others against all in blocks."""
    rows = written(placed, "large-nodes")
    least = rows.groupBy("node").agg(F.min("id").alias("id"))
    head = least.join(rows, ["node", "id"]).select("node", F.col("id").alias("head"), F.col("n").alias("hn"), *(F.col(f"s{k}").alias(f"h{k}") for k in range(4)))
    parts = [F.col(f"s{k}").bitwiseXOR(F.col(f"h{k}")) for k in range(4)]
    apart = sum((F.bit_count(p.bitwiseOR(F.shiftrightunsigned(p, 1)).bitwiseAND(F.lit(_ODD))) for p in parts), F.lit(0))
    near = (F.least("n", "hn") >= threshold * F.greatest("n", "hn") - 1e-9) & (apart <= most_apart(threshold))
    held = written(rows.join(head, "node").withColumn("near", near).select(*rows.columns, "head", "near"), "held")
    counts = held.groupBy("node").agg(F.count(F.lit(1)).alias("k"), F.count_if(~F.col("near")).alias("f"))

    def run(group: pa.Table) -> pa.Table:
        group = group.combine_chunks()
        ids, n, sketch, side = group.column("id").to_numpy(), group.column("n").to_numpy(), _sketches(group), group.column("side").to_numpy()
        xs, ys, pairs = np.flatnonzero(side == 0), np.flatnonzero(side == 1), []
        for x in xs:
            j = ys[_alike(n, sketch, np.full(len(ys), x), ys, threshold)]
            pairs.append((np.full(len(j), x), j))
        i, j = (np.concatenate([p[k] for p in pairs]) if pairs else np.empty(0, np.int64) for k in (0, 1))
        head = heads_of(i, j, len(ids))
        return pa.table({"a": pa.array(ids), "b": pa.array(ids[head])})

    blocks = dealt(held.drop("head"), "node", ~F.col("near"), counts, NODE)
    met = blocks.groupBy("node", "cx", "cy").applyInArrow(run, "a long, b long")
    return held.where("near").select(F.col("id").alias("a"), F.col("head").alias("b")).unionByName(met).where("a <> b")


def groups(sigs: DataFrame, percent: int, recall: float) -> DataFrame:
    """(id, component) of groups of representatives in sigs (id, n, sig) that no link leaves; ids alone are left out."""
    threshold = percent / 100
    rows = sigs.count()
    sample = sigs.orderBy(F.xxhash64("id"), "id").limit(SAMPLED).select("sig").collect()
    level = levels_for(np.array([np.frombuffer(r["sig"], "<u2") for r in sample]).reshape(-1, POSITIONS), rows)
    placed = paths(sigs.select("id", "n", "sig"), level, trees_for(level, recall), threshold)
    large = written(placed.select("node").groupBy("node").count().where(F.col("count") > NODE).select("node"), "large")
    few = large.count()
    if few:
        listed = F.broadcast(large) if few <= LISTED else large.hint("merge")
        alike = in_nodes(placed.join(listed, "node", "left_anti"), threshold).unionByName(in_large_nodes(placed.join(listed, "node", "left_semi"), threshold))
    else:
        alike = in_nodes(placed, threshold)
    return components(alike)


def linked(sets: list[np.ndarray], xs: np.ndarray, ys: np.ndarray, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """The pairs of xs and ys with 100 * intersection >= percent * union, on whole sets."""
    sizes = np.array([len(s) for s in sets])
    _, codes = np.unique(np.concatenate(sets), return_inverse=True)
    starts = np.concatenate([[0], np.cumsum(sizes)])
    of_y = np.concatenate([codes[starts[y] : starts[y + 1]] for y in ys])
    begin = np.concatenate([[0], np.cumsum(sizes[ys])])[:-1]
    mark = np.zeros(int(codes.max()) + 1, np.int32)
    found = []
    for x in xs:
        own = codes[starts[x] : starts[x + 1]]
        mark[own] = 1
        common = np.add.reduceat(mark[of_y], begin)
        mark[own] = 0
        j = ys[(100 * common >= percent * (sizes[x] + sizes[ys] - common)) & (ys != x)]
        found.append((np.full(len(j), x), j))
    return tuple(np.concatenate([f[k] for f in found]) for k in (0, 1))


def confirmed(rows: DataFrame, by: list[str], width: int, percent: int) -> DataFrame:
    """(a, b) for each group `by` of rows (id, text, side): a text and the smallest id that links of the group lead to.

    Texts of side 0 are compared with all, those of side 1 with those of side 0.
    """

    def run(group: pa.Table) -> pa.Table:
        kept("near_duplicates")
        group = group.combine_chunks().sort_by("id")
        ids, side = group.column("id").to_numpy(), group.column("side").to_numpy()
        sets = [s for batch in pieces(group.to_batches(), "text", 2 << 20) for s in shingle_sets(batch.column("text"), width)]
        same = np.flatnonzero(ids[1:] == ids[:-1])
        i, j = linked(sets, np.flatnonzero(side == 0), np.arange(len(ids)), percent) if (side == 0).any() else (same, same)
        head = heads_of(np.concatenate([i, same]), np.concatenate([j, same + 1]), len(ids))
        return pa.table({"a": pa.array(ids), "b": pa.array(ids[head])})

    return rows.select(*by, "id", "text", "side").groupBy(*by).applyInArrow(run, "a long, b long").where("a <> b")


def links(docs: DataFrame, grouped: DataFrame, width: int, percent: int) -> DataFrame:
    """(id, component) of the documents in grouped (id, component: the group) that a link joins to another of their group."""
    of = grouped.select("id", F.col("component").alias("of"))
    sizes = of.groupBy("of").agg(F.count(F.lit(1)).alias("k"))
    # Joined by shuffling at every size: the ids grow with the documents, so they are never sent to all tasks.
    texts = written(of.join(sizes, "of").hint("merge").join(docs, "id").select("id", "of", "k", "text"), "alike")
    small = confirmed(texts.where(F.col("k") <= GROUP).withColumn("side", F.lit(0)), ["of"], width, percent)
    small = written(small.select(F.col("a").alias("id"), F.col("b").alias("component")), "small")
    small = small.unionByName(small.select(F.col("component").alias("id"), "component").distinct())
    large = texts.where(F.col("k") > GROUP)
    if not large.limit(1).count():
        return small
    chunks = F.ceil(F.col("k") / GROUP)
    pivots = large.groupBy("of", F.pmod(F.xxhash64(F.lit(1), "id"), F.lit(PIVOTS)).alias("part")).agg(F.min("id").alias("id")).select("id")
    spread = large.join(pivots, "id").withColumn("chunk", F.explode(F.sequence(F.lit(0).cast("long"), chunks - 1))).withColumn("side", F.lit(0))
    own = large.join(pivots, "id", "left_anti").withColumn("chunk", F.pmod(F.xxhash64("id"), chunks)).withColumn("side", F.lit(1))
    edges = written(confirmed(spread.unionByName(own), ["of", "chunk"], width, percent), "edges")
    named = written(components(edges), "named")
    labelled = written(large.select("id", "of", "k").join(named, "id", "left").select("id", "of", "k", F.coalesce("component", "id").alias("c")), "labelled")
    main = labelled.groupBy("of", "c").agg(F.count(F.lit(1)).alias("n")).groupBy("of").agg(F.max(F.struct("n", "c")).alias("m"), F.sum("n").alias("k"))
    counts = written(main.select("of", F.col("m.c").alias("main"), "k", (F.col("k") - F.col("m.n")).alias("f")), "counts")
    open_ = large.select("id", "text").join(labelled.join(counts.select("of", "main"), "of").select("id", "of", (F.col("c") != F.col("main")).alias("open")), "id")
    more = confirmed(dealt(open_, "of", F.col("open"), counts.select("of", "k", "f"), GROUP), ["of", "cx", "cy"], width, percent)
    return small.unionByName(components(edges.unionByName(written(more, "edges"))))


def classes(docs: DataFrame, width: int, percent: int = 80, recall: float = TARGET_RECALL, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """id, n (set size) and component (the smallest id that links lead to), for each id of docs."""
    rows = docs.where(F.col(id_column).isNotNull()).select(F.col(id_column).cast("long").alias("id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    every = written(signatures(rows, width), "signatures")
    if every.groupBy("id").count().where("count > 1").limit(1).count():
        rows = rows.groupBy("id").agg(F.min("text").alias("text"))
        every = written(signatures(rows, width), "signatures")
    same = every.where("n > 0").groupBy("p1", "p2", "n").agg(F.min("id").alias("rep"))
    member = every.select("id", "n", "p1", "p2").join(same.hint("merge"), ["p1", "p2", "n"], "left").select("id", "n", F.coalesce("rep", "id").alias("rep"))
    member = written(member, "members")
    reps = written(every.where("n > 0").join(same.select(F.col("rep").alias("id")).hint("merge"), "id", "left_semi").select("id", "n", "sig"), "representatives")
    remove(every)
    named = links(rows, groups(reps, percent, recall), width, percent).select(F.col("id").alias("rep"), "component")
    return member.join(named, "rep", "left").select("id", "n", F.coalesce("component", "rep").alias("component"))


def deduplicate(docs: DataFrame, width: int = 5, id_column: str = "doc_id", text: str = "text", **how) -> DataFrame:
    """The rows of docs that keep: one document of each class, the one of smallest id; rows without id stay."""
    gone = classes(docs, width, id_column=id_column, text=text, **how).where("id <> component").select(F.col("id").alias("near_dup_gone"))
    return docs.join(gone, docs[id_column] == gone["near_dup_gone"], "left_anti")


def op5_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = classes(table(spark, sf_dir, "documents").select("doc_id", "text"), width=2)
    return found.select(F.col("id").alias("doc_id"), F.col("n").alias("n_shingles"), F.col("component").alias("component_id"), (F.col("id") == F.col("component")).alias("kept"))


OP5_SQL = """
WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+') AS ws FROM documents),
s AS (SELECT DISTINCT doc_id, unnest(CASE WHEN len(ws) = 0 THEN [] WHEN len(ws) < 2 THEN [array_to_string(ws, ' ')] ELSE list_transform(range(1, len(ws)), lambda i: ws[i] || ' ' || ws[i + 1]) END) AS g FROM w),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS k FROM s a JOIN s b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY 1, 2),
e AS (SELECT x, y FROM p JOIN n i ON i.doc_id = x JOIN n j ON j.doc_id = y WHERE 100 * k >= 80 * (i.n + j.n - k)),
l AS (SELECT x, y FROM e UNION ALL SELECT y, x FROM e),
r(doc_id, c) AS (SELECT x, x FROM l UNION SELECT l.y, r.c FROM r JOIN l ON l.x = r.doc_id),
m AS (SELECT doc_id, min(c) AS c FROM r GROUP BY doc_id)
SELECT d.doc_id, CAST(coalesce(n.n, 0) AS BIGINT) AS n_shingles, coalesce(m.c, d.doc_id) AS component_id, coalesce(m.c, d.doc_id) = d.doc_id AS kept
FROM documents d LEFT JOIN n ON n.doc_id = d.doc_id LEFT JOIN m ON m.doc_id = d.doc_id
"""
