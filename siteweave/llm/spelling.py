"""Spelling variants: words of a corpus that differ by one code point, by a trie self-join with active-node sets.

For each node of a trie, the active nodes are those whose prefix is within one edit of its own. They are found level by level:
two nodes of one level are active if their parents are and both end in the same letter, or if they are siblings; a node and one
of the next level are active if it is the other's parent, or if their parents are active and both end in the same letter. Pairs
of active nodes at which words end are the result.

The vocabulary is too large for one trie, so it is dealt by context. Of two words that differ by one edit, the shorter one of
length m, either the first half of m agrees (the edit comes later) or the rest behind it does. Each word therefore joins, for
m its length and one less, the part of its first half and the part of the other half; the trie of a part holds what is left of
its words. A pair is given by one part only, told by the length of its common prefix. Parts with more than `most` words are
split by the same rule, until two code points are left; then the letters [a-zA-Z\\u00C0-\\u00FF] bound a part.

Nulls and empty texts have no runs; a null doc_id counts as empty in the hash that deletes letters; repeated rows count again. An empty table
gives no rows. Other columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siteweave.llm.common import LOWER, pieces, table, utf8, written

#: Words in one part, and rows that a task works on at once.
MOST, AT_ONCE = 100_000, 200_000


def runs(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends, in bytes, of the maximal runs [A-Za-z\\u00C0-\\u00FF]+ of texts that lie one behind the other."""
    plain = ((raw | 0x20) >= 0x61) & ((raw | 0x20) <= 0x7A)
    lead = np.zeros(len(raw), bool)
    lead[:-1] = (raw[:-1] == 0xC3) & ((raw[1:] & 0xC0) == 0x80)
    inside = plain | lead
    inside[1:] |= lead[:-1]
    edge = np.empty(len(raw) + 1, bool)
    edge[0] = edge[-1] = True
    np.not_equal(inside[1:], inside[:-1], out=edge[1:-1])
    edge[offsets] = True  # runs don't go on from one text to the next
    at = np.flatnonzero(edge)
    kept = inside[at[:-1]] if len(at) > 1 else np.empty(0, bool)
    return at[:-1][kept], at[1:][kept]


def word_counts(df: DataFrame, shortest: int = 7, every: int = 31, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """(word, n) of the lower-cased runs, with a letter deleted where the hash of document and run is a multiple of `every`.

    The CRC of "<id>:<run>" is put together from those of its parts (crc(a + b) is crc(a) moved on by len(b) zeros, xor
    crc(b)), so each part is read once.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, text, 4 << 20):
            raw, offsets = utf8(batch.column(text))
            starts, ends = runs(raw, offsets)
            # A run of k code points has k bytes and one more for each letter above z.
            above = np.append(0, np.cumsum((raw & 0xC0) == 0x80))
            long = ends - starts - (above[ends] - above[starts]) >= shortest
            starts, ends = starts[long], ends[long]
            if not len(starts):
                continue
            # Between two kept runs lies what is dropped: every other string of this array is a run.
            cuts = np.empty(2 * len(starts) + 1, np.int64)
            cuts[0:-1:2], cuts[1::2], cuts[-1] = starts, ends, len(raw)
            every_other = pa.LargeStringArray.from_buffers(2 * len(starts), pa.py_buffer(cuts), pa.py_buffer(LOWER[raw]))
            coded = every_other.take(pa.array(np.arange(0, 2 * len(starts), 2))).dictionary_encode()
            code, words = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64), coded.dictionary
            plain = [w.encode() for w in words.to_pylist()]
            crc, size = np.array([zlib.crc32(w) for w in plain], np.uint32), np.array([*map(len, plain)])
            doc = np.searchsorted(offsets, starts, side="right") - 1
            pair, where = np.unique(doc << 32 | size[code], return_inverse=True)
            heads = [zlib.crc32(f"{'' if i is None else i}:".encode()) for i in batch.column(id_column).to_pylist()]
            zeros = bytes(int(size.max()))
            moved = np.array([zlib.crc32(zeros[:k], heads[d]) ^ zlib.crc32(zeros[:k]) for d, k in zip((pair >> 32).tolist(), (pair & 0xFFFFFFFF).tolist(), strict=True)], np.uint32)
            h = moved[where] ^ crc[code]
            cut = h % every == 0
            n = np.bincount(code[~cut], minlength=len(words))
            more: dict[str, int] = {}
            for c, x in zip(code[cut].tolist(), h[cut].tolist(), strict=True):
                w = words[c].as_py()
                at = x % len(w)
                w = w[:at] + w[at + 1 :]
                if len(w) >= shortest:
                    more[w] = more.get(w, 0) + 1
            seen = n > 0
            yield pa.RecordBatch.from_arrays([pa.concat_arrays([words.filter(pa.array(seen)).cast(pa.string()), pa.array([*more], pa.string())]), pa.array(np.append(n[seen], np.array([*more.values()], np.int64)))], names=["word", "n"])

    return df.select(F.col(id_column).cast("string").alias(id_column), F.col(text).cast("string").alias(text)).mapInArrow(run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))


def _parts(words: DataFrame) -> DataFrame:
    """(m, a, b, upto, head, tail, word, n): the word's parts. Words of a part share the first a and the last b code points;
    pairs of it have less than `upto` code points in common at their beginning."""
    lengths = words.withColumn("size", F.length("word")).withColumn("m", F.explode(F.array(F.col("size"), F.col("size") - 1))).where("m > 0")
    half = F.floor(F.col("m") / 2).cast("int")
    never = F.lit(2**31 - 1)
    both = F.array(F.struct(half.alias("a"), F.lit(0).alias("b"), never.alias("upto")), F.struct(F.lit(0).alias("a"), (F.col("m") - half).alias("b"), half.alias("upto")))
    return _keyed(lengths.withColumn("_p", F.explode(both)).select("word", "n", "m", "_p.*"))


def _keyed(rows: DataFrame) -> DataFrame:
    key = F.concat_ws("|", "m", "a", "b", "upto", F.expr("left(word, a)"), F.expr("right(word, b)"))
    return rows.withColumn("part", key)


def _split(rows: DataFrame) -> DataFrame:
    """The parts of the rows, each one in two: the edit comes in the later half of what is left, or in the earlier half."""
    free = F.col("m") - F.col("a") - F.col("b")
    mid = (F.col("a") + free - F.floor(free / 2)).cast("int")
    both = F.array(F.struct(mid.alias("a"), F.col("b"), F.col("upto")), F.struct(F.col("a"), (F.col("m") - mid).alias("b"), F.least(mid, F.col("upto")).alias("upto")))
    return _keyed(rows.withColumn("_p", F.explode(both)).select("word", "n", "m", "_p.*"))


def dealt(words: DataFrame, most: int = MOST) -> DataFrame:
    """The parts of the words (word, n), split until none has more than `most` words or two code points are left."""
    done, rows = None, _parts(words)
    while True:
        rows = written(rows, "parts")
        large = rows.where("m - a - b > 2").groupBy("part").count().where(F.col("count") > most).select("part")
        if not large.take(1):
            return rows if done is None else done.unionByName(rows)
        large = written(large, "large-parts")
        small = rows.join(large, "part", "left_anti")
        done = small if done is None else done.unionByName(small)
        rows = _split(rows.join(large, "part", "left_semi"))


def _expand(first: np.ndarray, count: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows and their items: row k has the count[k] items from first[k] on."""
    row = np.repeat(np.arange(len(count)), count)
    return row, np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count) + first[row]


def near_pairs(flat: np.ndarray, offsets: np.ndarray, root: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(x, y, common): pairs of strings of the same root at a distance of one edit, and the length of their common prefix.

    flat and offsets hold the strings' code points; strings are distinct within a root, roots ascend and strings ascend within
    one. Of two strings of different lengths, x is the shorter one. All tries grow by a level at a time.
    """
    size = np.diff(offsets)
    at = root.astype(np.int64)  # the node of each string at this level
    n_nodes = int(at[-1]) + 1 if len(at) else 0
    word = np.full(n_nodes, -1)  # the string that ends at a node
    word[at[size == 0]] = np.flatnonzero(size == 0)
    living = np.flatnonzero(size > 0)
    same = tuple(np.empty(0, np.int64) for _ in range(3))  # active pairs (u, v, common) of this level
    step = same  # active pairs of the level above and this one
    found = []
    level, above_first, above_count = 0, None, None
    while len(living):
        char = flat[offsets[living] + level]
        new = np.append(True, (at[living][1:] != at[living][:-1]) | (char[1:] != char[:-1]))
        node = np.cumsum(new) - 1
        parent, letter = at[living][new], char[new].astype(np.int64)
        count = np.bincount(parent, minlength=n_nodes)
        first = np.cumsum(count) - count
        key = parent << 21 | letter  # ascends
        ends = np.full(len(parent), -1)
        over = size[living] == level + 1
        ends[node[over]] = living[over]

        def child(of: np.ndarray, c: np.ndarray, key: np.ndarray = key) -> tuple[np.ndarray, np.ndarray]:
            want = of << 21 | c
            place = np.minimum(np.searchsorted(key, want), len(key) - 1)
            return place, key[place] == want

        # A node and one of the next level.
        x, y, z = [parent], [np.arange(len(parent))], [np.full(len(parent), level)]
        if len(step[0]):
            row, kid = _expand(above_first[step[0]], above_count[step[0]])
            v, hit = child(step[1][row], here[kid])
            hit &= kid != step[1][row]  # else kid is the parent, as above, with more in common
            x, y, z = [*x, kid[hit]], [*y, v[hit]], [*z, step[2][row][hit]]
        step = tuple(map(np.concatenate, (x, y, z)))
        # Two of this level: children by the same letter of two that were active, and siblings.
        row, kid = _expand(first[same[0]], count[same[0]])
        v, hit = child(same[1][row], letter[kid])
        later = np.arange(len(parent)) + 1
        one, two = _expand(later, (first + count)[parent] - later)
        same = tuple(map(np.concatenate, ((kid[hit], one), (v[hit], two), (same[2][row][hit], np.full(len(one), level)))))
        for a, b, (u, v, common) in ((word, ends, step), (ends, ends, same)):
            both = (a[u] >= 0) & (b[v] >= 0)
            found.append((a[u[both]], b[v[both]], common[both]))
        above_first, above_count, here = first, count, letter
        at[living] = node
        living = living[size[living] > level + 1]
        word, n_nodes, level = ends, len(parent), level + 1
    return tuple(map(np.concatenate, zip(*found, strict=True))) if found else same


def variants(words: DataFrame, most: int = MOST) -> DataFrame:
    """(word, other, n_other) of words (word, n) that differ by one code point, each pair in both directions."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in _whole_parts(batches):
            heads = pc.dictionary_encode(t.column("part")).combine_chunks()
            m, a, b, upto = (t.column(c).to_numpy() for c in ("m", "a", "b", "upto"))
            words = t.column("word").combine_chunks()
            size = pc.utf8_length(words).to_numpy().astype(np.int64)
            points = np.frombuffer("".join(words.to_pylist()).encode("utf-32-le"), np.uint32)
            start = np.cumsum(size) - size + a
            left = size - a - b
            row, where = _expand(start, left)
            flat, offsets = points[where], np.append(0, np.cumsum(left))
            x, y, common = near_pairs(flat, offsets, heads.indices.to_numpy(zero_copy_only=False))
            # Pairs whose shorter word has length m, and that no other part gives.
            keep = (size[x] == m[x]) & (common + a[x] < upto[x])
            x, y = x[keep], y[keep]
            n = t.column("n").to_numpy()
            one, two = pa.array(np.concatenate([x, y])), np.concatenate([y, x])
            for k in range(0, len(two), 1 << 16):
                part = pa.array(two[k : k + (1 << 16)])
                yield pa.RecordBatch.from_arrays([words.take(one.slice(k, 1 << 16)), words.take(part), pa.array(n[two[k : k + (1 << 16)]])], names=["word", "other", "n_other"])

    # UTF-8 ascends as code points do.
    rows = dealt(words, most).select("part", "m", "a", "b", "upto", "word", "n")
    return rows.repartition("part").sortWithinPartitions("part", "word").mapInArrow(run, "word string, other string, n_other long")


def _whole_parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Tables of about AT_ONCE rows, cut between parts."""
    held, rows, last = [], 0, None
    for batch in batches:
        if not batch.num_rows:
            continue
        if rows >= AT_ONCE:
            # Rows that go on with the part that was begun stay with it.
            n = pc.index(pc.equal(batch.column("part"), last), False).as_py()
            if n >= 0:
                yield pa.Table.from_batches([*held, batch.slice(0, n)])
                held, rows, batch = [], 0, batch.slice(n)
        held.append(batch)
        rows += batch.num_rows
        last = batch.column("part")[batch.num_rows - 1].as_py()
    if held:
        yield pa.Table.from_batches(held)


def roots(forms: DataFrame) -> DataFrame:
    """(word, root) for the rows (word, form): forms followed to the last. Forms lead to ever more frequent words, so there are no
    circles, and each round doubles what is covered."""
    now = written(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        further = now.select(F.col("word").alias("root"), F.col("root").alias("next"))
        if not now.join(further, "root", "left_semi").take(1):
            return now
        now = written(now.join(further, "root", "left").select("word", F.coalesce("next", "root").alias("root")), "roots")


def grouped(words: DataFrame, factor: int = 10, most: int = MOST) -> DataFrame:
    """(word, n, n_near, form, form_n, root) for the words (word, n)."""
    words = written(words, "words")
    best = variants(words, most).groupBy("word").agg(F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("n_other")).alias("less"), F.col("other").alias("other"))).alias("b"))
    met = words.join(best, "word", "left")
    clear = -F.col("b.less") >= factor * F.col("n")
    out = written(met.select("word", "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"), F.when(clear, F.col("b.other")).alias("form"), F.when(clear, -F.col("b.less")).alias("form_n")), "forms")
    return out.join(roots(out.where("form is not null")), "word", "left").withColumn("root", F.coalesce("root", "word"))


def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of at least seven code points and two occurrences, with their forms and roots."""
    return grouped(word_counts(table(spark, sf_dir, "documents")).where("n >= 2")).select("word", "form", "root", "n", "n_near", "form_n")


_CRC_TABLE = "list_transform(range(256), lambda i: list_reduce(list_prepend(i::bigint, range(8)), lambda c, k: case when c % 2 = 1 then xor(c >> 1, 3988292384::bigint) else c >> 1 end))"
OP13_SQL = rf"""
with crc as (select {_CRC_TABLE} as t),
runs as (select doc_id, unnest(regexp_extract_all(coalesce(text, ''), '[A-Za-z\x{{C0}}-\x{{FF}}]+')) as run from documents),
lowered as (select doc_id, translate(run, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as run from runs where length(run) >= 7),
counted as (select doc_id, run, count(*) as c from lowered group by all),
hashed as (
  select run, c, xor(4294967295::bigint, list_reduce(list_prepend(4294967295::bigint, list_transform(range(octet_length(encode(k))), lambda i: ('0x' || substr(hex(encode(k)), 2 * i::int + 1, 2))::bigint)),
    lambda s, b: xor(s >> 8, t[xor(s, b) % 256 + 1]))) as h
  from (select *, coalesce(doc_id::varchar, '') || ':' || run as k from counted), crc),
made as (select case when h % 31 = 0 then substr(run, 1, (h % length(run))::int) || substr(run, (h % length(run))::int + 2) else run end as word, c from hashed),
words as (select word, sum(c)::bigint as n from made where length(word) >= 7 group by word having sum(c) >= 2),
gaps as (select word, n, i, substr(word, 1, i::int - 1) as a, substr(word, i::int + 1) as b from (select word, n, unnest(range(1, length(word) + 1)) as i from words)),
pairs as (
  select x.word, y.word as other, y.n as m from gaps x join gaps y on x.i = y.i and x.a = y.a and x.b = y.b and x.word <> y.word
  union select x.word, y.word, y.n from gaps x join words y on x.a || x.b = y.word
  union select y.word, x.word, x.n from gaps x join words y on x.a || x.b = y.word),
best as (select word, count(*) as n_near, first(other order by m desc, encode(other)) as other, max(m) as m from pairs group by word),
forms as (select w.word, w.n, coalesce(n_near, 0)::bigint as n_near, case when b.m >= 10 * w.n then other end as form, case when b.m >= 10 * w.n then b.m end::bigint as form_n from words w left join best b on w.word = b.word),
chain as (
  with recursive up(word, top) as (select word, word from forms union all select up.word, f.form from up join forms f on f.word = up.top and f.form is not null)
  select word, top as root from up where not exists (select 1 from forms f where f.word = up.top and f.form is not null))
select f.word, f.form, c.root, f.n, f.n_near, f.form_n from forms f join chain c on f.word = c.word
"""
