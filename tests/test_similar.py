"""Searches by indexes and bounds against brute force."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from siteweave.functions.similarity import token_set, token_sort
from siteweave.operators import linkage, similar


def addresses(rng, n):
    road = lambda: f"{rng.choice(['CL', 'KR', 'AV', 'TV'])} {rng.randint(1, 30)}{rng.choice(['', 'A', 'B', ' BIS'])}"
    made = lambda: f"{road()} # {rng.randint(1, 30)}-{rng.randint(1, 60)}{rng.choice(['', ' EL LIDO', ' GRANADA', ' APTO 3', ' TORRE 2 UNIDAD RESIDENCIAL LOS GUADUALES DEL NORTE SECTOR INDUSTRIAL'])}"
    out = [made() for _ in range(n)]
    for _ in range(n // 2):  # mistyped, turned round and run together
        t = list(rng.choice(out))
        for _ in range(rng.randint(1, 4)):
            t[rng.randrange(len(t))] = rng.choice(["", "X", "7", " ", "O"])
        words = "".join(t).split(" ")
        rng.shuffle(words) if rng.random() < 0.3 else None
        out.append(" ".join(words))
    return [*out, "", " ", "A", "# #", "é" * 80, "é" * 79 + "e", "x y " * 40]


@pytest.mark.parametrize(("ratio", "least", "k", "distinct"), [(token_set, 88.0, 5, True), (token_sort, 92.0, 1, False), (token_set, 70.0, 3, True)])
def test_set_search_equals_brute_force(spark, ratio, least, k, distinct):
    rng = random.Random(11)
    asked, sites = sorted({*addresses(rng, 60)}), [(j, t) for j, t in enumerate(addresses(rng, 160) + addresses(random.Random(11), 60))]
    brute = [(t, pos, -r) for t in asked if t.split() for r, pos in sorted((-ratio(t, s), pos) for pos, s in sites if s.split() and ratio(t, s) >= least)[:k]]
    texts = spark.createDataFrame([*((t, 1) for t in asked), (None, 1), (asked[3], 2)], "t string, pos int")
    got = similar.set_search(texts, spark.createDataFrame([*sites, (999, None)], "pos long, t string"), ratio, least, k, distinct)
    got = sorted((r["key_text"], -r["ratio"], r["pos"]) for r in got.collect())
    assert [(t, pos, -r) for t, r, pos in got] == brute and len(brute) > 60


def test_set_search_looks_at_few_pairs(spark):
    rng = random.Random(12)
    asked, sites = {*addresses(rng, 200)}, [*enumerate(addresses(rng, 600))]
    seen = spark.sparkContext.accumulator(0)

    def counting(s, t):
        seen.add(1)
        return token_set(s, t)

    similar.set_search(spark.createDataFrame([(t,) for t in asked], "t string"), spark.createDataFrame(sites, "pos long, t string"), counting, 88.0, 5).count()
    assert 0 < seen.value < 0.1 * len(asked) * len(sites)
    empty = spark.createDataFrame([], "pos long, t string")
    assert similar.set_search(empty.select("t"), spark.createDataFrame(sites, "pos long, t string"), token_set, 88.0, 5).count() == 0
    assert similar.set_search(spark.createDataFrame([("A B C",)], "t string"), empty, token_set, 88.0, 5).count() == 0


def grams(t):
    out = {}
    for w in t.lower().split():
        p = f" {w} "
        for n in (2, 3, 4):
            for i in range(len(p) - n + 1):
                out[p[i : i + n]] = out.get(p[i : i + n], 0) + 1
    return out


@pytest.mark.parametrize("least", [0.82, 0.3])
@pytest.mark.parametrize("first", [similar.FIRST_LEVEL, 2.0])
def test_text_pairs_equal_brute_force(spark, monkeypatch, least, first):
    monkeypatch.setattr(similar, "FIRST_LEVEL", first)
    rng = random.Random(13)
    asked, sites = sorted({*addresses(rng, 50)}), sorted({*addresses(rng, 120), *addresses(random.Random(13), 50)})
    n = [rng.randint(1, 3) for _ in sites]
    df = {}
    for t, k in zip(sites, n, strict=True):
        for g in grams(t):
            df[g] = df.get(g, 0) + k
    idf = {g: np.log((1 + sum(n)) / (1 + d)) + 1 for g, d in df.items()}

    def vector(t):
        w = {g: k * idf[g] for g, k in grams(t).items() if g in idf}
        norm = np.sqrt(sum(x * x for x in w.values()))
        return {g: x / norm for g, x in w.items()}

    x, y = [vector(t) for t in asked], [vector(t) for t in sites]
    want = {(i, j): s for i, a in enumerate(x) for j, b in enumerate(y) if (s := sum(w * b.get(g, 0) for g, w in a.items())) >= least}
    left = spark.createDataFrame([*enumerate(asked)], "a long, t string")
    right = spark.createDataFrame([(j, t, k) for j, (t, k) in enumerate(zip(sites, n, strict=True))], "b long, t string, n long")
    got = {(r["a"], r["b"]): r["sim"] for r in linkage.tfidf_pairs(left, right, least).collect()}
    assert got.keys() == want.keys() and all(abs(got[p] - want[p]) < 1e-12 for p in want) and len(want) > 50


def vectors(rng, n, clusters, dim=16):
    middle = rng.normal(size=(clusters, dim))
    return (middle[rng.integers(clusters, size=n)] + 0.15 * rng.normal(size=(n, dim))).astype(float)


@pytest.mark.parametrize(("k", "least"), [(5, 0.75), (10, -1.0)])
def test_nearest_vectors_equal_brute_force(spark, monkeypatch, k, least):
    monkeypatch.setattr(similar, "SAMPLED", 200)
    monkeypatch.setattr(similar, "BLOCK", 50)
    rng = np.random.default_rng(14)
    asked, sites = vectors(rng, 120, 9), np.vstack([vectors(np.random.default_rng(15), 700, 12), np.zeros((2, 16))])
    sites[500:600] = sites[500]  # many alike
    sites = np.vstack([sites, asked[:40], -asked[:5]])
    unit = lambda m: m / (np.linalg.norm(m, axis=1, keepdims=True) + 1e-9)
    sim = np.round(unit(np.vstack([asked, np.zeros((1, 16))])) @ unit(sites).T, 12)
    want = {(i, int(j), round(float(s[j]), 10)) for i, s in enumerate(sim) for j in np.lexsort((np.arange(len(s)), -s))[:k] if s[j] >= least}
    left = spark.createDataFrame([*((i, v.tolist()) for i, v in enumerate(np.vstack([asked, np.zeros((1, 16))]))), (900, None), (901, [1.0, None]), (902, [float("nan")] * 16)], "ask long, emb array<double>")
    right = spark.createDataFrame([*((j, v.tolist()) for j, v in enumerate(sites)), (9_000, None)], "pos long, emb array<double>")
    got = {(r["ask"], r["pos"], round(r["sim"], 10)) for r in similar.nearest_vectors(left, right, k, least).collect()}
    assert got == want
    assert similar.nearest_vectors(left, right.limit(0), k, least).count() == similar.nearest_vectors(left.limit(0), right, k, least).count() == 0


def test_bounds_rule_out_most_pairs(spark):
    rng = np.random.default_rng(16)
    middle = rng.normal(size=(30, 16))
    made = lambda n: (middle[rng.integers(30, size=n)] + 0.1 * rng.normal(size=(n, 16))).tolist()
    asked = spark.createDataFrame([*enumerate(made(300))], "ask long, emb array<double>")
    sites = spark.createDataFrame([*enumerate(made(3_000))], "b long, emb array<double>")
    visits, placed = similar.visited_units(asked, sites, 5, 0.75)
    met = visits.groupBy("unit").count().join(placed.groupBy("unit").agg(F.count(F.lit(1)).alias("n")), "unit").agg(F.sum(F.col("count") * F.col("n"))).first()[0]
    assert met < 0.25 * 300 * 3_000


def test_pairs_of_texts_move_no_vectors(spark, monkeypatch):
    # Vectors were joined to each pair that might reach the cosine; now blocks meet blocks, and only pairs that do are given.
    monkeypatch.setattr(similar, "VECTORS", 30)
    monkeypatch.setattr(similar, "PRODUCTS", 500)
    monkeypatch.setattr(similar, "WHOLE", 7)
    rng = random.Random(5)
    texts = sorted({*addresses(rng, 150)})
    left = spark.createDataFrame([*enumerate(texts)], "a long, t string")
    right = spark.createDataFrame([(j, t, 1) for j, t in enumerate(texts)], "b long, t string, n long")
    pairs = linkage.tfidf_pairs(left, right, 0.82)
    got = {(r["a"], r["b"]): r["sim"] for r in pairs.collect()}
    monkeypatch.undo()
    whole = {(r["a"], r["b"]): r["sim"] for r in linkage.tfidf_pairs(left, right, 0.82).collect()}
    monkeypatch.setattr(similar, "LAID", 0)
    assert got == whole == {(r["a"], r["b"]): r["sim"] for r in linkage.tfidf_pairs(left, right, 0.82).collect()} and all((k, k) in got for k, t in enumerate(texts) if t.split())
    assert "Join" not in pairs._jdf.queryExecution().executedPlan().toString()
