"""Exact searches for similar texts and vectors through indexes whose bounds rule most pairs out.

* gram_cosines: pairs of sparse unit vectors that reach a cosine, by partial products of an L2-norm prefix index;
* set_search: the k most similar texts by a ratio of words, by words that both must share or letters that both must share;
* nearest_vectors: the k nearest dense vectors, by cells around pivots and the triangle inequality.

Null texts and vectors take no part. Equal texts or vectors are searched once. Ties go to the smaller `pos`. Empty tables give
no rows.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from itertools import combinations
from math import acos, ceil, comb, floor, pi

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from siteweave.shared import written

# Sparse vectors ------------------------------------------------------------------------------------------------------

#: Postings of a level of grams are up to twice as long as those of the level below; the first level's are up to so long.
FIRST_LEVEL = 32.0
#: Vectors of either side in a block of pairs at most, products and sums at a time, pairs whose whole cosine is taken at a time, and
#: weights that are laid out for them.
VECTORS, PRODUCTS, SUMS, WHOLE, LAID = 32_768, 1 << 21, 1 << 20, 4_096, 1 << 22


def levelled(rows: DataFrame, key: str, least: float) -> DataFrame:
    """(key, x, level, rest) of rows (key, x), x the unit vector as an array of (df, gram, w) by df.

    Grams are sorted into levels by their frequency in the index. A vector's level is the first one such that its grams beyond
    are shorter together, by the norm `rest`, than 5/6 of the root of the least cosine.
    """
    grade = lambda df: F.greatest(F.ceil(F.log2(df / F.lit(FIRST_LEVEL))), F.lit(0)).cast("int")
    graded = rows.withColumn("x", F.transform("x", lambda g: F.struct(grade(g["df"]).alias("level"), g["gram"].alias("gram"), g["w"].alias("w"))))
    most = least * 25 / 36
    start = F.struct(F.lit(0.0).alias("sum"), F.lit(-1).alias("level"))
    step = lambda s, g: F.struct((s["sum"] + g["w"] * g["w"]).alias("sum"), F.when((s["level"] < 0) & (s["sum"] + g["w"] * g["w"] > most), g["level"]).otherwise(s["level"]).alias("level"))
    out = graded.withColumn("level", F.aggregate(F.reverse("x"), start, step)["level"])
    beyond = F.aggregate("x", F.lit(0.0), lambda s, g: s + F.when(g["level"] > F.col("level"), g["w"] * g["w"]).otherwise(0.0))
    return out.select(key, "x", "level", F.sqrt(beyond).alias("rest"))


class Vectors:
    """Sparse vectors of a block: ids, rests, and their grams and weights one after the other, the first `own` of each within its level."""

    def __init__(self, t: pa.Table) -> None:
        self.ids, self.rests, own = (t.column(c).to_numpy() for c in ("id", "rest", "own"))
        grams = t.column("grams").combine_chunks()
        sizes = pc.list_value_length(grams).to_numpy(zero_copy_only=False).astype(np.int64)
        self.begin = np.append(0, np.cumsum(sizes))
        self.grams, self.weights = pc.list_flatten(grams).to_numpy(), pc.list_flatten(t.column("weights").combine_chunks()).to_numpy()
        self.row = np.repeat(np.arange(len(sizes)), sizes)
        self.own = np.arange(len(self.grams)) - self.begin[self.row] < own[self.row]

    def at(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Numbers of the vectors in these rows, and where their grams are."""
        sizes = self.begin[rows + 1] - self.begin[rows]
        upto = np.append(0, np.cumsum(sizes))
        number = np.repeat(np.arange(len(rows)), sizes)
        return number, np.arange(upto[-1]) + np.repeat(self.begin[rows] - upto[:-1], sizes)

    def of(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Numbers, grams and weights of the vectors in these rows."""
        number, at = self.at(rows)
        return number, self.grams[at], self.weights[at]


def pair_cosines(one: tuple[np.ndarray, np.ndarray, np.ndarray], two: tuple[np.ndarray, np.ndarray, np.ndarray], count: int) -> np.ndarray:
    """Cosines of `count` pairs of vectors, each side given as the numbers of the pairs, grams and weights."""
    (pa_, ga, wa), (pb, gb, wb) = one, two
    # Grams of one pair get keys of their own, so that one search finds the common grams of all pairs.
    own = lambda g, p: g.view(np.uint64) + p.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    x, y = own(ga, pa_), own(gb, pb)
    order = np.argsort(y)
    place = np.minimum(np.searchsorted(y, x, sorter=order), max(0, len(y) - 1))
    hit = y[order[place]] == x if len(y) else np.zeros(len(x), bool)
    return np.bincount(pa_[hit], wa[hit] * wb[order[place[hit]]], count)


def _whole_cosines(x: Vectors, y: Vectors, pairs: Iterator[tuple[np.ndarray, np.ndarray]], least: float) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Those of the pairs (rows of x and y) that reach the least cosine, with it."""
    names = np.unique(y.grams)
    place = np.minimum(np.searchsorted(names, x.grams), max(0, len(names) - 1))
    place = np.where(names[place] == x.grams, place, len(names)) if len(names) else np.zeros(len(x.grams), np.int64)
    column = np.searchsorted(names, y.grams)
    # y's weights are laid out by grams if many vectors find room; each pair's products are summed in the order of x's grams either way.
    room = min(WHOLE, LAID // (len(names) + 1))
    laid = np.zeros((room, len(names) + 1)) if room >= 64 else None
    most = room if laid is not None else WHOLE
    for some, others in pairs:
        for at in range(0, len(some), most):
            i, j = some[at : at + most], others[at : at + most]
            if laid is None:
                sims = pair_cosines(x.of(i), y.of(j), len(i))
            else:
                number, entry = y.at(j)
                laid[number, column[entry]] = y.weights[entry]
                mine, own = x.at(i)
                sims = np.bincount(mine, x.weights[own] * laid[mine, place[own]], len(i))
                laid[number, column[entry]] = 0.0
            good = sims >= least
            if good.any():
                yield i[good], j[good], sims[good]


def _reaching(x: Vectors, y: Vectors, least: float) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Rows of x and y whose vectors may reach the least cosine."""
    # Postings of y: all of each gram, for vectors that have it within their level, and after them those within y's own level.
    rows, by = [], []
    for some in (np.arange(len(y.grams)), np.flatnonzero(y.own)):
        order = some[np.argsort(y.grams[some], kind="stable")]
        rows.append(order)
        by.append(y.grams[order])
    first, last = (np.where(x.own, np.searchsorted(by[0], x.grams, side), len(by[0]) + np.searchsorted(by[1], x.grams, side)) for side in ("left", "right"))
    posting = np.concatenate(rows)
    held, weight = y.row[posting], y.weights[posting]
    count = last - first
    upto, n, k = np.append(0, np.cumsum(count)), len(y.ids), 0
    heads = upto[x.begin]
    while k < len(x.ids):
        # Whole vectors of so many products at a time, and of sums as many as a processor keeps at hand.
        lo = x.begin[k]
        end = max(k + 1, min(int(np.searchsorted(heads, upto[lo] + PRODUCTS)), k + max(1, SUMS // max(1, n)), len(x.ids)))
        hi = x.begin[end]
        entry = np.repeat(np.arange(lo, hi), count[lo:hi])
        at = np.arange(len(entry)) - (upto[entry] - upto[lo]) + first[entry]
        pair, products = (x.row[entry] - k) * n + held[at], x.weights[entry] * weight[at]
        if len(pair) * 32 >= (end - k) * n:
            sums = np.bincount(pair, products, (end - k) * n)
            pair = np.flatnonzero(sums > 0)
            sums = sums[pair]
        else:
            pair, which = np.unique(pair, return_inverse=True)
            sums = np.bincount(which, products)
        i, j = pair // max(1, n) + k, pair % max(1, n)
        good = sums + x.rests[i] * y.rests[j] >= least - 1e-9
        yield i[good], j[good]
        k = end


def gram_cosines(left: DataFrame, right: DataFrame, least: float) -> DataFrame:
    """(a, b, sim): pairs of vectors (a and b long, rest, own, grams, weights; the first `own` grams are those within the vector's level)
    that reach the least cosine.

    For two vectors, products are summed over the grams up to the higher one of their levels. The grams beyond add no more than
    the product of both rests, so a pair is dropped if the sum and that product fall short; the others' cosines are taken on the whole
    vectors. Blocks of the left side meet blocks of the right one; a vector is moved once for each block that it meets, and no pair
    is moved but those that reach the cosine.
    """
    many = 2 * left.sparkSession.sparkContext.defaultParallelism
    na, nb = (max(1, d.count()) for d in (left, right))
    parts, blocks = (max(-(-n // VECTORS), min(ceil((many * n / m) ** 0.5), n)) for n, m in ((na, nb), (nb, na)))
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    dealt = lambda c, n: F.pmod(F.xxhash64(c), F.lit(n)).cast("int")
    kept = ["id", "rest", "own", "grams", "weights"]
    x = left.withColumnRenamed("a", "id").select(*kept, F.lit(True).alias("asks"), dealt("id", parts).alias("part"), every(blocks).alias("block"))
    y = right.withColumnRenamed("b", "id").select(*kept, F.lit(False).alias("asks"), dealt("id", blocks).alias("block"), every(parts).alias("part"))
    # Pairs of blocks are numbered, so that a task has one of them.
    met = x.unionByName(y).repartitionById(parts * blocks, F.col("part") * blocks + F.col("block"))

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [b for b in batches if b.num_rows]
        if not held:
            return
        both = pa.Table.from_batches(held)
        held.clear()
        x, y = Vectors(both.filter(both.column("asks"))), Vectors(both.filter(pc.invert(both.column("asks"))))
        del both
        for i, j, sims in _whole_cosines(x, y, _reaching(x, y, least), least):
            yield pa.RecordBatch.from_arrays([pa.array(x.ids[i]), pa.array(y.ids[j]), pa.array(sims)], names=["a", "b", "sim"])

    return met.select(*kept, "asks").mapInArrow(meet, "a long, b long, sim double")


# Sets of words -------------------------------------------------------------------------------------------------------

#: Texts longer than this meet by single letters; most keys of a text for one length of the other; letters counted for rarity.
LONG, MOST_KEYS, COUNTED = 64, 40, 4_096


def _joined(text: str, distinct: bool) -> str:
    return " ".join(sorted(set(text.split()) if distinct else text.split()))


def _letters(text: str) -> list[tuple[str, int]]:
    """The letters of a text, numbered where they repeat."""
    seen: dict[str, int] = {}
    out = []
    for ch in text:
        seen[ch] = seen.get(ch, 0) + 1
        out.append((ch, seen[ch]))
    return out


def _keys(text: str, least: float, order: dict[int, int], left: bool) -> set[int]:
    """Keys of which two texts have one in common if their longest common subsequence reaches least / 200 of both lengths.

    Such texts share o letters, repeats counted. Without one of the first n - o + 1 of n letters, in an order alike for all texts,
    that can't be; and of the first n - o + c they share c. Keys are the sets of c letters among these, for each length that
    the other text may have.
    """
    n, low = len(text), least / (200 - least)
    letters = sorted((ord(ch) << 20 | min(k, (1 << 20) - 1) for ch, k in _letters(text)), key=lambda t: (order.get(t, 0), t))
    out: set[int] = set()
    for m in range(ceil(n * low - 1e-9), min(LONG, floor(n / low + 1e-9)) + 1) if n <= LONG else ():
        shared = ceil(least / 200 * (n + m) - 1e-9)
        mine, other = n - shared + 1, m - shared + 1
        if shared < 1 or mine < 1 or other < 1:
            continue
        c = 1
        while c < min(8, shared) and comb(max(mine, other) + c, c + 1) <= MOST_KEYS:
            c += 1
        lengths = (n, m) if left else (m, n)
        out.update(map(hash, (lengths + one for one in combinations(letters[: mine + c - 1], c))))
    if n / low > LONG:
        out.update(hash((-1, t)) for t in letters[: n - ceil(n * low - 1e-9) + 1])
    return out


def set_search(texts: DataFrame, sites: DataFrame, ratio: Callable[[str, str], float], least: float, k: int, distinct: bool = True) -> DataFrame:
    """(key_text, pos, ratio): the k most similar sites (pos, t) of each of the texts (t), at the floor or above.

    ratio: token_set (distinct words) or token_sort (all words, distinct=False). A token-set ratio reaches the floor in two
    ways. Either the shared words make up so much of one side's words that one of its rarest words, those without which the
    rest would be too short, is shared; or the longest common subsequence is so long that both share a key of letters.
    """
    spark = texts.sparkSession
    asked = written(texts.where("t is not null").select("t").distinct().withColumn("a", F.monotonically_increasing_id()), "asked")
    known = sites.where("t is not null").select("pos", "t")
    held = written(known.groupBy("t").agg(F.min("pos").alias("b")), "held")
    first = F.row_number().over(Window.partitionBy("t").orderBy("pos"))
    places = known.withColumn("_k", first).where(F.col("_k") <= k).drop("_k").join(held, "t").select("b", "pos")

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            seen: dict[int, int] = {}
            for t in batch.column("t").to_pylist():
                for ch, j in _letters(_joined(t, distinct)):
                    seen[ord(ch) << 20 | j] = seen.get(ord(ch) << 20 | j, 0) + 1
            yield pa.RecordBatch.from_pydict({"letter": pa.array([*seen], pa.int64()), "n": pa.array([*seen.values()], pa.int64())})

    often = held.select("t").mapInArrow(counted, "letter long, n long").groupBy("letter").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), "letter").limit(COUNTED).collect()
    order = {r["letter"]: r["n"] for r in often}

    def keyed(key: str, left: bool):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for at in range(0, batch.num_rows, 512):
                    part = batch.slice(at, 512)
                    keys = [[*_keys(_joined(t, distinct), least, order, left)] for t in part.column("t").to_pylist()]
                    ids = np.repeat(part.column(key).to_numpy(), [*map(len, keys)])
                    yield pa.RecordBatch.from_arrays([pa.array(ids), pa.array([x for own in keys for x in own], pa.int64())], names=[key, "key"])

        return run

    pairs = asked.select("a", "t").mapInArrow(keyed("a", True), "a long, key long").join(held.select("b", "t").mapInArrow(keyed("b", False), "b long, key long"), "key").select("a", "b")
    if distinct:
        pairs = pairs.unionByName(_by_words(asked, held, least))
    met = pairs.distinct().join(asked.withColumnRenamed("t", "s"), "a").join(held, "b").select("a", "s", "b", "t")

    def rated(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b, r = [], [], []
            for i, s, j, t in zip(*(batch.column(c).to_pylist() for c in ("a", "s", "b", "t")), strict=True):
                if (x := ratio(s, t)) >= least:
                    a.append(i)
                    b.append(j)
                    r.append(x)
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64()), pa.array(r, pa.float64())], names=["a", "b", "ratio"])

    found = met.mapInArrow(rated, "a long, b long, ratio double").join(places, "b")
    rank = F.row_number().over(Window.partitionBy("a").orderBy(F.desc("ratio"), "pos"))
    best = found.withColumn("_k", rank).where(F.col("_k") <= k)
    return best.join(asked, "a").select(F.col("t").alias("key_text"), "pos", "ratio")


def _by_words(asked: DataFrame, held: DataFrame, least: float) -> DataFrame:
    """(a, b) of texts that share a word without which a side's shared words can't reach least / (200 - least) of its length."""

    def words(key: str):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                sets = [sorted(set(t.split())) for t in batch.column("t").to_pylist()]
                ids = np.repeat(batch.column(key).to_numpy(), [*map(len, sets)])
                flat = [w for s in sets for w in s]
                size = np.repeat([len(" ".join(s)) for s in sets], [*map(len, sets)])
                yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(flat, pa.string()), pa.array([len(w) + 1 for w in flat], pa.int64()), pa.array(size, pa.int64())], names=[key, "word", "mass", "size"])

        return run

    kind = "word string, mass long, size long"
    left = written(asked.select("a", "t").mapInArrow(words("a"), f"a long, {kind}"), "words")
    right = written(held.select("b", "t").mapInArrow(words("b"), f"b long, {kind}"), "words")
    share = least / (200 - least)

    def lead(own: DataFrame, key: str, other: DataFrame) -> DataFrame:
        n = other.groupBy("word").agg(F.count(F.lit(1)).alias("n"))
        rest = Window.partitionBy(key).orderBy("n", "word").rowsBetween(Window.currentRow, Window.unboundedFollowing)
        # Words that the other side lacks can't be shared, so they don't count.
        return own.join(n, "word").withColumn("left", F.sum("mass").over(rest) - 1).where(F.col("left") >= share * F.col("size") - 1e-9).select(key, "word")

    return lead(left, "a", right).join(right.select("b", "word"), "word").select("a", "b").unionByName(left.select("a", "word").join(lead(right, "b", left), "word").select("a", "b"))


# Dense vectors -------------------------------------------------------------------------------------------------------

#: Pivots at most, width of a ring in radians, vectors that give the first bound, and rows of either side in a block.
PIVOTS, RING, SAMPLED, BLOCK = 128, 0.2, 8_192, 4_096
#: Shorter vectors have no direction; they are compared with all.
_SHORT, _SLACK = 1e-3, 1e-6


def _unit(m: np.ndarray) -> np.ndarray:
    return m / (np.linalg.norm(m, axis=1, keepdims=True) + 1e-9)


def _matrix(column: pa.Array) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(column), -1) if len(column) else np.empty((0, 0))


def _angles(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    return np.arccos(np.clip(x @ y.T, -1.0, 1.0))


def _pivots(sample: np.ndarray, most: int) -> np.ndarray:
    """Directions spread over a sample: each next one is the farthest from those before."""
    count = max(1, min(most, ceil(len(sample) ** 0.5)))
    chosen = [0]
    near = sample @ sample[0]
    while len(chosen) < count:
        chosen.append(int(np.argmin(near)))
        near = np.maximum(near, sample @ sample[chosen[-1]])
    return sample[chosen]


class Cells:
    """Pivots, the units (cell and ring) that sites fall into, and for each unit the range of angles to every pivot."""

    def __init__(self, pivots: np.ndarray) -> None:
        self.pivots = pivots
        self.names = np.empty(0, np.int64)
        self.low = self.high = np.empty((0, len(pivots)))

    def units(self, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The unit of each vector and its angles to the pivots; short vectors are unit -1."""
        angles = _angles(_unit(vectors), self.pivots)
        cell = angles.argmin(1)
        unit = cell * 64 + (angles[np.arange(len(angles)), cell] / RING).astype(np.int64)
        return np.where(np.linalg.norm(vectors, axis=1) < _SHORT, -1, unit), angles

    def within(self, angles: np.ndarray, reach: np.ndarray) -> np.ndarray:
        """For each row of angles to the pivots, which units may hold a vector within `reach`."""
        out = np.zeros((len(angles), len(self.names)), bool)
        for u in range(len(self.names)):
            gap = np.maximum(angles - self.high[u], self.low[u] - angles).max(1)
            out[:, u] = (gap <= reach) | (self.names[u] < 0)
        return out


def _sampled(sites: DataFrame, n: int) -> np.ndarray:
    h, count = F.xxhash64("emb"), sites.count()
    # A threshold on the hash bounds what the tasks send: without it, each would send n rows.
    some = sites if count <= 2 * n else sites.where(F.pmod(h, F.lit(1 << 30)) < int((1 << 30) * min(1.0, 1.2 * n / count)))
    rows = some.orderBy(h, "b").limit(n).select("emb").collect()
    return np.array([r["emb"] for r in rows], np.float64)


def _usable(emb: Column) -> Column:
    return emb.isNotNull() & (F.size(emb) > 0) & ~F.exists(emb, lambda x: x.isNull() | F.isnan(x))


def visited_units(asked: DataFrame, sites: DataFrame, k: int, least: float) -> tuple[DataFrame, DataFrame]:
    """(ask, emb, unit) with the units that may hold one of the k nearest sites at `least` or above, and (b, emb, unit) of the sites."""
    spark: SparkSession = asked.sparkSession
    sample = _sampled(sites, SAMPLED)
    lengths = np.linalg.norm(sample, axis=1) if len(sample) else np.empty(0)
    firm = _unit(sample[lengths >= _SHORT]) if len(sample) else sample
    if not len(firm):  # no site has a direction: one unit for all
        return asked.withColumn("unit", F.lit(-1).cast("long")), sites.withColumn("unit", F.lit(-1).cast("long"))
    cells = Cells(_pivots(firm, PIVOTS))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                unit, angles = cells.units(_matrix(batch.column("emb")))
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(unit), pa.array([*angles], pa.list_(pa.float64()))], names=["b", "emb", "unit", "angles"])

    kind = dict(sites.dtypes)["emb"]
    placed = written(sites.select("b", "emb").mapInArrow(place, f"b long, emb {kind}, unit long, angles array<double>"), "placed")
    # Ranges of angles of each unit; there are at most as many units as pivots times rings.
    ranges = placed.select("unit", F.posexplode("angles").alias("p", "angle")).groupBy("unit", "p").agg(F.min("angle").alias("low"), F.max("angle").alias("high")).groupBy("unit").agg(F.sort_array(F.collect_list(F.struct("p", "low", "high"))).alias("r")).orderBy("unit").collect()
    cells.names = np.array([r["unit"] for r in ranges], np.int64)
    cells.low, cells.high = (np.array([[x[f] for x in r["r"]] for r in ranges]) for f in ("low", "high"))
    shared = spark.sparkContext.broadcast((cells, firm))
    floor_angle = acos(max(-1.0, min(1.0, least)))

    def visit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cells, firm = shared.value
        for whole in batches:
            for at in range(0, whole.num_rows, 512):
                batch = whole.slice(at, 512)
                vectors = _matrix(batch.column("emb"))
                reach = np.full(len(vectors), floor_angle)
                if len(firm) >= k:
                    best = np.partition(_angles(_unit(vectors), firm), k - 1, axis=1)[:, k - 1]
                    reach = np.minimum(reach, best)
                reach = np.where(np.linalg.norm(vectors, axis=1) < _SHORT, pi, reach) + _SLACK
                row, unit = np.nonzero(cells.within(_angles(_unit(vectors), cells.pivots), reach))
                picked = batch.take(pa.array(row))
                yield pa.RecordBatch.from_arrays([*picked.columns, pa.array(cells.names[unit])], names=["ask", "emb", "unit"])

    return asked.select("ask", "emb").mapInArrow(visit, f"ask long, emb {dict(asked.dtypes)['emb']}, unit long"), placed.select("b", "emb", "unit")


def nearest_vectors(asked: DataFrame, sites: DataFrame, k: int, least: float = -1.0) -> DataFrame:
    """(ask, pos, sim): for each vector (ask, emb) the k sites (pos, emb) of largest cosine, at `least` or above.

    Sites are dealt to cells around pivots and to rings by their angle to the pivot. A bounded sample gives each vector a first
    bound on its k-th best angle; the triangle inequality over all pivots then rules out the units that can't hold a nearer
    site. Blocks of what is left are compared. Vectors with nulls or NaNs take no part; all must be of one length.
    """
    asked = asked.where(_usable(F.col("emb"))).select("ask", "emb")
    known = sites.where(_usable(F.col("emb"))).select("pos", "emb").withColumn("h", F.xxhash64("emb"))
    held = written(known.groupBy("h").agg(F.min("pos").cast("long").alias("b"), F.min("emb").alias("emb")), "vectors")
    first = F.row_number().over(Window.partitionBy("h").orderBy("pos"))
    places = known.withColumn("_k", first).where(F.col("_k") <= k).join(held.select("h", "b"), "h").select("b", "pos")
    visits, placed = visited_units(written(asked, "asked"), held, k, least)
    visits = written(visits, "visited")
    # Blocks of either side in a unit, from counts of at most as many rows as units.
    blocks = lambda d, name: d.groupBy("unit").agg(F.ceil(F.count(F.lit(1)) / BLOCK).cast("int").alias(name))
    both = blocks(visits, "parts").join(blocks(placed, "blocks"), "unit")
    dealt = lambda c, n: F.pmod(F.xxhash64(c), F.col(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    left = visits.join(both, "unit").withColumn("part", dealt("ask", "parts")).withColumn("block", every("blocks")).select("unit", "part", "block", "ask", "emb")
    right = placed.join(both, "unit").withColumn("block", dealt("b", "blocks")).withColumn("part", every("parts")).select("unit", "part", "block", "b", "emb")

    def top(x: pa.Table, y: pa.Table) -> pa.Table:
        if not x.num_rows or not y.num_rows:
            return pa.table({"ask": pa.array([], pa.int64()), "b": pa.array([], pa.int64()), "sim": pa.array([], pa.float64())})
        y = y.sort_by("b")
        ids, b = x.column("ask").to_numpy(), y.column("b").to_numpy()
        one, two = (_unit(_matrix(t.column("emb").combine_chunks())) for t in (x, y))
        out = []
        for at in range(0, len(one), 1_024):
            sim = np.round(one[at : at + 1_024] @ two.T, 12)
            best = np.argsort(-sim, axis=1, kind="stable")[:, :k]
            out.append((np.repeat(ids[at : at + 1_024], best.shape[1]), b[best].ravel(), np.take_along_axis(sim, best, 1).ravel()))
        whole = [np.concatenate(c) for c in zip(*out, strict=True)]
        keep = whole[2] >= least
        return pa.table({n: c[keep] for n, c in zip(("ask", "b", "sim"), whole, strict=True)})

    keys = ["unit", "part", "block"]
    found = left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(top, "ask long, b long, sim double")
    few = Window.partitionBy("ask").orderBy(F.desc("sim"), "b")
    found = found.withColumn("_k", F.row_number().over(few)).where(F.col("_k") <= k).drop("_k").join(places, "b")
    rank = F.row_number().over(Window.partitionBy("ask").orderBy(F.desc("sim"), "pos"))
    return found.withColumn("_k", rank).where(F.col("_k") <= k).select("ask", "pos", "sim")
