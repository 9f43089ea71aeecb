"""Prefix tries of conversations: which beginnings of turns are shared, by how many, and what sharing them saves.

A node is a distinct sequence of first d turns. Turns are numbered along ranges of the order and a sequence is named by its
length and the exclusive or of hashes of its turns and their places (two of 64 bits), so that neither a long conversation nor
many conversations of one beginning meet in a task.

The trie is cut below each node that more than `members` conversations share. What lies above the cuts, the heavy upper levels,
is merged by joins and sums. Each subtree below a cut is a shard; a task makes level-order tries of many shards at once: a LOUDS
bitvector (a node's children as ones, then a zero) and an array of labels. Roll-ups run through it in reverse level order with
add.at. Where a single conversation goes on alone there is no branch any more; a trie holds the first node of such a tail, the
rest follows from its length.

Rows without a conv_id take no part. Null turns come first, null roles and texts are empty, ties of turn go by role and text;
repeated rows are turns of their own. Other columns are ignored. An empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from siteweave.llm.common import table, written

#: Conversations of a shard, and nodes that a task works on at once.
MEMBERS, AT_ONCE = 128, 200_000
_WORDS = r"[^\x20\x09-\x0D]+"
_PATH = ["d", "p1", "p2"]


def along(df: DataFrame, key: str, order: list[Column], running: dict[str, tuple[str, Column]]) -> DataFrame:
    """df with values that run along the order within each key; running: column to ("sum" or "xor", value).

    Rows are dealt by ranges of key and order. A key that begins in an earlier range is carried on from there; each range has
    one such key at most, so what is carried is as short as the list of ranges.
    """
    named = {f"_o{k}": c for k, c in enumerate(order)}
    rows = df.withColumns(named | {f"_v{k}": c for k, (_, c) in enumerate(running.values())})
    rows = written(rows.repartitionByRange(key, *named).withColumn("_range", F.spark_partition_id()), "ranges")
    fold = {"sum": F.sum, "xor": F.bit_xor}
    values = {f"_v{k}": fold[how] for k, (how, _) in enumerate(running.values())}
    totals = rows.groupBy("_range", key).agg(*(f(v).alias(v) for v, f in values.items()))
    before = Window.partitionBy(key).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    carried = totals.select("_range", key, *(f(v).over(before).alias(f"_c{v}") for v, f in values.items())).where(" or ".join(f"_c{v} is not null" for v in values))
    upto = Window.partitionBy("_range", key).orderBy(*named).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    here = rows.select("*", *(f(v).over(upto).alias(f"_h{v}") for v, f in values.items())).join(F.broadcast(carried), ["_range", key], "left")
    out = {}
    for (name, (how, _)), v in zip(running.items(), values, strict=True):
        carry = F.coalesce(F.col(f"_c{v}"), F.lit(0).cast("long"))
        out[name] = F.col(f"_h{v}") + carry if how == "sum" else F.col(f"_h{v}").bitwiseXOR(carry)
    return here.withColumns(out).select(*df.columns, *running)


def turns(df: DataFrame) -> DataFrame:
    """(conv_id, pos, a, b, words): the turns of each conversation by number, hashed."""
    read = df.where("conv_id is not null").select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), *(F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("role", "text")))
    hashes = {n: F.xxhash64(F.lit(seed), "role", "text") for n, seed in (("a", 17), ("b", 9_176))}
    # Ranges of the order are drawn with null turns last, so whether there is a turn comes before it.
    order = [F.col("turn").isNotNull(), F.coalesce("turn", F.lit(0).cast("long")), F.col("role"), F.col("text")]
    rows = along(read, "conv_id", order, {"pos": ("sum", F.lit(1).cast("long"))})
    return rows.select("conv_id", "pos", *(c.alias(n) for n, c in hashes.items()), F.regexp_count("text", F.lit(_WORDS)).cast("long").alias("words"))


def rebuilt(rows: DataFrame, group: int = 20, heads: int = 4) -> tuple[DataFrame, DataFrame]:
    """(conv_id, len) and (conv_id, d, a, b, words): each conversation c begins with the first h turns of c - c % group, h the CRC
    of c modulo `heads`, and goes on with its own turns behind its first h."""
    convs = written(rows.groupBy("conv_id").agg(F.max("pos").alias("n")), "conversations")
    asks = convs.withColumns({"base": F.col("conv_id") - F.col("conv_id") % group, "h": F.crc32(F.col("conv_id").cast("string")) % heads})
    has = convs.select(F.col("conv_id").alias("base"), F.col("n").alias("n_base"))
    plan = written(asks.join(has, "base", "left").withColumn("k", F.least("h", F.coalesce("n_base", F.lit(0).cast("long")))), "plan")
    first = rows.where((F.col("conv_id") % group == 0) & (F.col("pos") < heads)).select(F.col("conv_id").alias("base"), F.col("pos").alias("d"), "a", "b", "words")
    begun = plan.select("conv_id", "base", "h").join(first, "base").where("d <= h").select("conv_id", "d", "a", "b", "words")
    own = rows.join(plan.select("conv_id", "h", "k"), "conv_id").where("pos > h").select("conv_id", (F.col("k") + F.col("pos") - F.col("h")).alias("d"), "a", "b", "words")
    lengths = plan.select("conv_id", (F.col("k") + F.greatest(F.col("n") - F.col("h"), F.lit(0).cast("long"))).alias("len"))
    return lengths, begun.unionByName(own)


def paths(lengths: DataFrame, rows: DataFrame) -> DataFrame:
    """rows with the name of the sequence up to each turn (p1, p2), of the one before (q1, q2), and whether it is the last."""
    salted = {n: F.xxhash64(F.col(n), F.col("d")) for n in ("a", "b")}
    named = along(rows.select("conv_id", "d", *(c.alias(n) for n, c in salted.items()), "words"), "conv_id", [F.col("d")], {"p1": ("xor", F.col("a")), "p2": ("xor", F.col("b"))})
    named = named.withColumns({"q1": F.col("p1").bitwiseXOR(F.col("a")), "q2": F.col("p2").bitwiseXOR(F.col("b"))})
    return written(named.join(lengths, "conv_id").select("conv_id", *_PATH, "q1", "q2", F.col("a").alias("label"), "words", (F.col("d") == F.col("len")).alias("last")), "paths")


def louds(parent: np.ndarray) -> np.ndarray:
    """The bitvector of a forest in level order: for each node behind a common root, which comes first, its children as ones and
    then a zero. parent: of each node, -1 for the trees' tops, not descending."""
    degree = np.bincount(parent + 1, minlength=len(parent) + 1)
    bits = np.ones(len(parent) + len(degree), np.uint8)
    bits[np.cumsum(degree + 1) - 1] = 0
    return bits


def parents(bits: np.ndarray) -> np.ndarray:
    """The parent of each node: the j-th one stands behind as many zeros as its parent's number in level order."""
    ones = np.flatnonzero(bits)
    return ones - np.arange(len(ones)) - 1


def _pairs(one: np.ndarray, two: np.ndarray, *more: tuple[np.ndarray, np.ndarray]) -> list[np.ndarray]:
    """Equal numbers for equal pairs of 64-bit numbers, over several arrays of pairs."""
    all_ = [(one, two), *more]
    ranks = [np.unique(np.concatenate([p[k] for p in all_]), return_inverse=True)[1].astype(np.int64) for k in (0, 1)]
    both = ranks[0] * (ranks[1].max() + 1 if len(ranks[1]) else 1) + ranks[1]
    return np.split(both, np.cumsum([len(p[0]) for p in all_])[:-1])


class Trie:
    """Level-order tries of several shards: `order` gives the rows by node, `bits` and `labels` are the tries, `levels` their
    levels' borders."""

    def __init__(self, shard: np.ndarray, d: np.ndarray, p: tuple[np.ndarray, np.ndarray], q: tuple[np.ndarray, np.ndarray], label: np.ndarray) -> None:
        # Depths below the shard's top; rows are sorted by shard and depth.
        top = np.append(True, shard[1:] != shard[:-1])
        depth = d - d[top][np.cumsum(top) - 1]
        rows = np.flatnonzero(depth == 0)
        order, parent, levels, count = [rows], [np.full(len(rows), -1)], [0, len(rows)], len(rows)
        for level in range(1, int(depth.max()) + 1):
            next_ = np.flatnonzero(depth == level)
            above, below = _pairs(p[0][rows], p[1][rows], (q[0][next_], q[1][next_]))
            by = np.argsort(above)
            place = by[np.searchsorted(above, below, sorter=by)]
            turn = np.lexsort((label[next_], place))
            rows, place = next_[turn], place[turn]
            order.append(rows)
            parent.append(place + levels[-2])
            levels.append(levels[-1] + len(rows))
        self.order, self.levels = np.concatenate(order), levels
        self.bits, self.labels = louds(np.concatenate(parent)), label[self.order]
        self.parent = parents(self.bits)
        ends = np.flatnonzero(self.bits == 0)
        self.children = np.diff(ends) - 1

    def upward(self, values: np.ndarray, fold=np.add) -> np.ndarray:
        """Values of the nodes folded over their subtrees, from the lowest level to the top."""
        out = values.copy()
        for lo, hi in zip(self.levels[-2:0:-1], self.levels[:1:-1], strict=True):
            fold.at(out, self.parent[lo:hi], out[lo:hi])
        return out


def _whole_shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Tables of about AT_ONCE rows, cut between shards."""
    held, rows, last = [], 0, None
    for batch in batches:
        if not batch.num_rows:
            continue
        s1, s2 = (batch.column(c).to_numpy() for c in ("s1", "s2"))
        if rows >= AT_ONCE:
            other = np.flatnonzero((s1 != last[0]) | (s2 != last[1]))
            if len(other):
                yield pa.Table.from_batches([*held, batch.slice(0, other[0])])
                held, rows, batch = [], 0, batch.slice(other[0])
        held.append(batch)
        rows += batch.num_rows
        last = s1[-1], s2[-1]
    if held:
        yield pa.Table.from_batches(held)


_NODE = "conv_id long, d long, p1 long, p2 long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, top boolean"


def _tries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for t in _whole_shards(batches):
        col = {c: t.column(c).to_numpy() for c in t.column_names}
        s1, s2 = col["s1"], col["s2"]
        shard = np.cumsum(np.append(True, (s1[1:] != s1[:-1]) | (s2[1:] != s2[:-1])))
        trie = Trie(shard, col["d"], (col["p1"], col["p2"]), (col["q1"], col["q2"]), col["label"])
        by = {c: col[c][trie.order] for c in ("d", "p1", "p2", "conv_id", "n_convs", "ends", "words")}
        # Members end at a node or go on below it; a tail's top stands for its whole tail.
        tail = by["n_convs"] == 1
        n_convs = trie.upward(np.where(tail, 1, by["ends"]))
        conv_id = trie.upward(by["conv_id"], np.minimum)
        leaves = trie.upward((trie.children == 0).astype(np.int64))
        saved = trie.upward((n_convs - 1) * by["words"])
        inner = trie.parent >= 0
        parent = pa.array(np.where(inner, conv_id[trie.parent], 0), mask=~inner)
        children = np.where(tail, 1 - by["ends"], trie.children)
        out = [conv_id, by["d"], by["p1"], by["p2"], parent, n_convs, children, leaves, saved, ~inner]
        whole = pa.RecordBatch.from_arrays([c if isinstance(c, pa.Array) else pa.array(c) for c in out], names=[f.split()[0] for f in _NODE.split(", ")])
        for at in range(0, whole.num_rows, 1 << 16):
            yield whole.slice(at, 1 << 16)


def end_hashes(ends: DataFrame) -> DataFrame:
    """(d, p1, p2, ends_sha256) of the conversations (conv_id) that end at each node: SHA-256 of their ids, ascending, with commas.

    Ids are sorted and joined by ranges; a node's pieces, as many as it has ranges, then go through one hash as they come.
    """
    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            path = [batch.column(c).to_numpy() for c in _PATH]
            ids = batch.column("conv_id").to_numpy()
            new = np.flatnonzero(np.append(True, np.logical_or.reduce([c[1:] != c[:-1] for c in path]))) if len(ids) else np.empty(0, np.int64)
            bounds = np.append(new, len(ids))
            text = [",".join(map(str, ids[lo:hi].tolist())) for lo, hi in zip(bounds[:-1], bounds[1:], strict=True)]
            yield pa.RecordBatch.from_arrays([*(pa.array(c[new]) for c in path), pa.array(ids[new]), pa.array(text, pa.string())], names=[*_PATH, "conv_id", "piece"])

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, state = None, None
        for batch in batches:
            done = []
            for *path, piece in zip(*(batch.column(c).to_pylist() for c in (*_PATH, "piece")), strict=True):
                if path != at:
                    if at is not None:
                        done.append((*at, state.hexdigest()))
                    at, state = path, hashlib.sha256(piece.encode())
                else:
                    state.update(f",{piece}".encode())
            if done:
                yield _rows(done)
        if at is not None:
            yield _rows([(*at, state.hexdigest())])

    def _rows(done: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*done, strict=True)], names=[*_PATH, "ends_sha256"])

    keys = "d long, p1 long, p2 long"
    pieces = ends.select(*_PATH, "conv_id").repartitionByRange(*_PATH, "conv_id").sortWithinPartitions(*_PATH, "conv_id").mapInArrow(join, f"{keys}, conv_id long, piece string")
    return pieces.repartition(*_PATH).sortWithinPartitions(*_PATH, "conv_id").mapInArrow(digest, f"{keys}, ends_sha256 string")


def trie(lengths: DataFrame, steps: DataFrame, members: int = MEMBERS) -> DataFrame:
    """A row for each node of the trie of all conversations: lengths has each of them, steps its paths()."""
    nodes = written(steps.groupBy(*_PATH, "q1", "q2").agg(F.count(F.lit(1)).alias("n_convs"), F.min("conv_id").alias("conv_id"), F.min("label").alias("label"), F.min("words").alias("words"), F.sum(F.col("last").cast("long")).alias("ends")), "nodes")
    heavy = written(nodes.where(F.col("n_convs") > members), "heavy")
    # Each conversation is cut below its last heavy node.
    cuts = steps.join(heavy.select(*_PATH), _PATH, "left_semi").groupBy("conv_id").agg((F.max("d") + 1).alias("cut"))
    cuts = lengths.select("conv_id").join(cuts, "conv_id", "left").select("conv_id", F.coalesce("cut", F.lit(1).cast("long")).alias("cut"))
    shards = written(steps.join(cuts, "conv_id").where("d = cut").select("conv_id", "cut", F.col("p1").alias("s1"), F.col("p2").alias("s2")), "shards")
    light = nodes.join(shards, "conv_id").where("d >= cut")
    tails = nodes.where("n_convs = 1").groupBy("conv_id").agg(F.min("d").alias("alone"))
    light = written(light.join(tails, "conv_id", "left"), "light")
    alone = F.coalesce(F.col("d") > F.col("alone"), F.lit(False)) & (F.col("n_convs") == 1)
    branching = light.where(~alone).select("s1", "s2", *_PATH, "q1", "q2", "label", "conv_id", "n_convs", "ends", "words")
    below = written(branching.repartition("s1", "s2").sortWithinPartitions("s1", "s2", "d").mapInArrow(_tries, _NODE), "tries")
    rest = light.where(alone).select("conv_id", *_PATH, F.col("conv_id").alias("parent_conv_id"), "n_convs", (1 - F.col("ends")).alias("n_children"), F.lit(1).cast("long").alias("n_leaves"), F.lit(0).cast("long").alias("saved_tokens"))

    # Heavy upper levels: what the cut-off subtrees and the heavy nodes bring goes to the conversation that stands for it, is
    # summed along its turns from the last one up, and then over the conversations of each heavy node.
    tops = below.where("top").select("conv_id", "d", *_PATH[1:], "n_leaves", "saved_tokens")
    above = heavy.select(*_PATH, "q1", "q2", "conv_id", "n_convs", "words")
    links = nodes.join(heavy.select(F.col("p1").alias("q1"), F.col("p2").alias("q2"), (F.col("d") + 1).alias("d")), ["d", "q1", "q2"]).groupBy("d", "q1", "q2").agg(F.count(F.lit(1)).alias("n_children"))
    links = links.select((F.col("d") - 1).alias("d"), F.col("q1").alias("p1"), F.col("q2").alias("p2"), "n_children")
    above = written(above.join(links, _PATH, "left").fillna(0, ["n_children"]), "above")
    own = above.select("conv_id", "d", (F.col("n_children") == 0).cast("long").alias("n_leaves"), ((F.col("n_convs") - 1) * F.col("words")).alias("saved_tokens"))
    brought = written(tops.select("conv_id", "d", "n_leaves", "saved_tokens").unionByName(own), "brought")
    along_turns = Window.partitionBy("conv_id").orderBy(F.desc("d")).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    who = brought.select("conv_id").distinct().join(cuts, "conv_id")
    upper = steps.join(who, "conv_id").where("d <= cut").select("conv_id", *_PATH, "cut").join(brought, ["conv_id", "d"], "left")
    upper = upper.withColumns({c: F.coalesce(F.sum(c).over(along_turns), F.lit(0).cast("long")) for c in ("n_leaves", "saved_tokens")})
    sums = upper.where("d < cut").groupBy(*_PATH).agg(F.sum("n_leaves").alias("n_leaves"), F.sum("saved_tokens").alias("saved_tokens"))
    above = above.join(sums, _PATH)

    # Parents of heavy nodes and of the cut-off subtrees' tops: heavy ones, or the root.
    smallest = lengths.agg(F.min("conv_id").alias("root_conv_id"))
    ids = heavy.select((F.col("d") + 1).alias("d"), F.col("p1").alias("q1"), F.col("p2").alias("q2"), F.col("conv_id").alias("above_conv_id"))
    hung = nodes.join(tops.select(*_PATH), _PATH, "left_semi").unionByName(heavy).where("d > 1").select(*_PATH, "q1", "q2").join(ids, ["d", "q1", "q2"]).select(*_PATH, "above_conv_id")
    columns = ["conv_id", *_PATH, "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens"]
    both = below.drop("top").unionByName(above.withColumn("parent_conv_id", F.lit(None).cast("long")).select(*columns)).join(hung, _PATH, "left").crossJoin(F.broadcast(smallest))  # one row
    parent = F.when(F.col("d") == 1, F.col("root_conv_id")).otherwise(F.coalesce("parent_conv_id", "above_conv_id"))
    named = both.withColumn("parent_conv_id", parent).select(*columns).unionByName(rest.select(*columns))

    # The root has all conversations; those without turns end there.
    firsts = nodes.where("d = 1").agg(F.count(F.lit(1)).alias("n_children"))
    sum_all = brought.agg(F.coalesce(F.sum("n_leaves"), F.lit(0).cast("long")).alias("n_leaves"), F.coalesce(F.sum("saved_tokens"), F.lit(0).cast("long")).alias("saved_tokens"))
    members_ = lengths.agg(F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("n_convs")).where("n_convs > 0")
    none = F.lit(0).cast("long")
    root = members_.crossJoin(firsts).crossJoin(sum_all).select("conv_id", none.alias("d"), none.alias("p1"), none.alias("p2"), F.lit(None).cast("long").alias("parent_conv_id"), "n_convs", "n_children", F.greatest("n_leaves", F.lit(1).cast("long")).alias("n_leaves"), "saved_tokens")  # one row each
    ended = steps.where("last").select(*_PATH, "conv_id").unionByName(lengths.where("len = 0").select(none.alias("d"), none.alias("p1"), none.alias("p2"), "conv_id"))
    return named.unionByName(root).join(end_hashes(ended), _PATH, "left").withColumn("ends_sha256", F.coalesce("ends_sha256", F.sha2(F.lit("").cast("binary"), 256)))


def conversation_trie(df: DataFrame, members: int = MEMBERS) -> DataFrame:
    """Nodes of the trie of rebuilt conversations (conv_id, turn, role, text)."""
    lengths, rows = rebuilt(written(turns(df), "turns"))
    return trie(written(lengths, "lengths"), paths(lengths, rows), members)


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = conversation_trie(table(spark, sf_dir, "conversations"))
    return out.select("conv_id", F.col("d").alias("depth"), "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")


_CRC = """xor(4294967295::bigint, list_reduce(list_prepend(4294967295::bigint, list_transform(range(length(c::varchar)), lambda i: ascii(substr(c::varchar, i::int + 1, 1))::bigint)),
    lambda s, b: list_reduce(list_prepend(xor(s, b), range(8)), lambda v, k: case when v % 2 = 1 then xor(v >> 1, 3988292384::bigint) else v >> 1 end)))"""
OP11_SQL = rf"""
with turns as (
  select conv_id as c, list({{'r': coalesce(role, ''), 't': coalesce(text, '')}} order by turn nulls first, coalesce(role, ''), coalesce(text, '')) as own from conversations where conv_id is not null group by conv_id),
rebuilt as (
  select x.c, coalesce(list_slice(b.own, 1, x.h::int), []) || list_slice(x.own, x.h::int + 1, length(x.own)) as path
  from (select *, {_CRC} % 4 as h from turns) x left join turns b on b.c = x.c - x.c % 20),
members as (select c, length(path) as n, unnest(range(0, length(path) + 1)) as d, path from rebuilt),
nodes as (
  select list_slice(path, 1, d::int) as p, d as depth, min(c) as conv_id, count(*) as n_convs, sha256(coalesce(string_agg(c::varchar, ',' order by c) filter (where n = d), '')) as ends_sha256
  from members group by all),
linked as (select x.*, u.conv_id as parent_conv_id from nodes x left join nodes u on x.depth > 0 and u.depth = x.depth - 1 and u.p = list_slice(x.p, 1, x.depth::int - 1)),
counted as (select x.depth, x.p, count(y.depth) as n_children from nodes x left join nodes y on y.depth = x.depth + 1 and list_slice(y.p, 1, x.depth::int) = x.p group by all),
valued as (select n.*, n_children, case when n.depth = 0 then 0 else (n_convs - 1) * len(regexp_extract_all(n.p[n.depth].t, '[^\x20\x09-\x0D]+')) end as saves from nodes n join counted c on n.depth = c.depth and n.p = c.p),
spread as (select list_slice(p, 1, u.d::int) as p, saves, (n_children = 0)::bigint as leaf from valued, lateral (select unnest(range(0, depth + 1)) as d) u),
rolled as (select p, sum(leaf) as n_leaves, sum(saves) as saved_tokens from spread group by p)
select l.conv_id, l.depth, l.parent_conv_id, l.n_convs, c.n_children, r.n_leaves::bigint as n_leaves, r.saved_tokens::bigint as saved_tokens, l.ends_sha256
from linked l join counted c on l.depth = c.depth and l.p = c.p join rolled r on l.p = r.p
"""
