import numpy as np
import pytest

from siteweave.llm import image_copies, near_duplicates, neighbours
from siteweave.llm.components import components


def brute_classes(rows, width=2):
    sets = {}
    for i, t in rows:
        if i is not None:
            w = (t or "").lower().split()
            sets[i] = {tuple(w)} if 0 < len(w) < width else {tuple(w[k : k + width]) for k in range(len(w) - width + 1)}
    label = {i: i for i in sets}
    ids = sorted(sets)
    changed = True
    while changed:
        changed = False
        for a in ids:
            for b in ids:
                n = len(sets[a] & sets[b])
                if a < b and n and 100 * n >= 80 * (len(sets[a]) + len(sets[b]) - n) and label[a] != label[b]:
                    label[a] = label[b] = min(label[a], label[b])
                    changed = True
    return {i: (len(sets[i]), label[i]) for i in ids}


def test_near_duplicates_equal_brute_force(spark):
    rng = np.random.default_rng(5)
    words = [f"w{k}" for k in range(300)]
    base = [" ".join(rng.choice(words, rng.integers(20, 80))) for _ in range(40)]
    rows = [(k, base[k % 40]) for k in range(50)]
    for k in range(50, 160):
        w = base[k % 10].split()
        for _ in range(rng.integers(0, 4)):
            w[rng.integers(len(w))] = rng.choice(words)
        rows.append((k, " ".join(w)))
    rows += [(200, None), (201, ""), (202, " \t"), (203, "One"), (204, "one"), (205, "x " * 30_000), (None, "gone gone")]
    got = near_duplicates.classes(spark.createDataFrame(rows, "doc_id long, text string"), 2).collect()
    assert {r["id"]: (r["n"], r["component"]) for r in got} == brute_classes(rows)


def test_near_duplicates_edges(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert near_duplicates.classes(empty, 2).count() == 0
    same = spark.createDataFrame([(1, "a b c d e f"), (1, "a b c d e f"), (2, "a b c d e f")], "doc_id long, text string")
    assert near_duplicates.deduplicate(same, 5).select("doc_id").distinct().count() == 1


def test_components(spark):
    links = spark.createDataFrame([(k, k + 1) for k in range(30)] + [(50, 51), (51, 51)], "a long, b long")
    got = dict(components(links).collect())
    assert all(got[k] == 0 for k in range(31)) and got[50] == got[51] == 50


def test_neighbours_recall_and_ties(spark):
    rng = np.random.default_rng(2)
    x = rng.normal(size=(1500, 16)).astype(np.float32)
    x[700:720] = x[0]
    rows = [(k, v.tolist()) for k, v in enumerate(x)] + [(5000, None), (5001, [0.0] * 16), (5002, [float("nan")] + [1.0] * 15), (5003, [1.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    got = neighbours.search(df, lambda i: i % 50 == 0).toPandas()
    u = x.astype(float) / np.linalg.norm(x.astype(float), axis=1, keepdims=True)
    hit = total = 0
    for q in range(0, 1500, 50):
        s = u @ u[q]
        s[q] = -9
        best = np.lexsort((np.arange(1500), -np.round(s, 12)))[:5]
        mine = got[got.query_id == q].sort_values("rank")
        hit += len(set(best) & set(mine.id))
        total += 5
        assert mine["rank"].tolist() == [1, 2, 3, 4, 5] and mine.score.is_monotonic_decreasing
    assert hit / total >= 0.9 and got[got.query_id == 0].sort_values("rank").id.tolist() == [700, 701, 702, 703, 704]
    assert neighbours.search(df.limit(0), lambda i: i % 50 == 0).count() == 0


def test_neighbours_are_never_too_few(spark, monkeypatch):
    import dataclasses

    plain = neighbours.fit
    monkeypatch.setattr(neighbours, "PER_CELL", 1)
    monkeypatch.setattr(neighbours, "cells_for", lambda rows: 40)
    monkeypatch.setattr(neighbours, "fit", lambda *a: dataclasses.replace(plain(*a), probes=1))
    x = np.random.default_rng(3).normal(size=(60, 8))
    df = spark.createDataFrame([(k, v.tolist(), "a", 1) for k, v in enumerate(x)], "vec_id long, embedding array<double>, cell string, q int")
    got = neighbours.search(df, lambda i: i % 10 == 0).groupBy("query_id").count().collect()
    assert {r["query_id"]: r["count"] for r in got} == dict.fromkeys(range(0, 60, 10), 5)
    assert neighbours.search(df.limit(1), lambda i: i % 10 == 0).count() == 0


def test_table_scan_equals_sums():
    rng = np.random.default_rng(1)
    x = rng.normal(size=(900, 12))
    index = neighbours.fit(x / np.linalg.norm(x, axis=1, keepdims=True), 900, 5)
    near = index.codes(x / np.linalg.norm(x, axis=1, keepdims=True), np.zeros(900, int))
    q, row, score = neighbours.scan(index, 0, near, x, x[:70], 900)
    assert len(q) == 70 * 900 and np.allclose(score, [(x[a] @ x[b]) / np.linalg.norm(x[a]) / np.linalg.norm(x[b]) for a, b in zip(q, row, strict=True)])
    q, row, _ = neighbours.scan(index, 0, near, x, x[:70], 20)
    assert (np.bincount(q) == 20).all() and np.mean([k in row[q == k] for k in range(70)]) > 0.9


def fields(rng, count, size=80):
    out = [128 + 50 * (f - f.mean()) / f.std() for f in (image_copies._box(image_copies._box(rng.normal(0, 1, (size, size)), 1), 1) for _ in range(count))]
    return np.clip(np.round(np.stack(out)), 0, 255).astype(np.float32)


def resized(image, factor):
    h, w = (round(n * factor) for n in image.shape)
    return image_copies._resampled(image.shape[0], h) @ image @ image_copies._resampled(image.shape[1], w).T


EDITS = {
    "crop": lambda x, rng: x[:, :50],
    "quarter turn": lambda x, rng: np.rot90(x).copy(),
    "0.5": lambda x, rng: resized(x, 0.5),
    "0.75": lambda x, rng: resized(x, 0.75),
    "1.5": lambda x, rng: resized(x, 1.5),
    "brightness": lambda x, rng: 0.7 * x + 40,
    "noise": lambda x, rng: x + rng.normal(0, 8, x.shape),
    "levels": lambda x, rng: np.round(x / 16) * 16,
    "blur": lambda x, rng: image_copies._box(x, 1),
}


@pytest.mark.parametrize("kind", EDITS)
def test_image_edits_are_recalled(kind):
    rng = np.random.default_rng(6)
    images = fields(rng, 30)
    got = [image_copies.corners(x[None])[0] for x in images]
    edited = [image_copies.corners(np.clip(np.round(EDITS[kind](x, rng)), 0, 255).astype(np.float32)[None])[0] for x in images]
    assert np.mean([image_copies.alike(a, b) for a, b in zip(got, edited, strict=True)]) >= 0.9
    assert not any(image_copies.alike(got[k], edited[k - 1]) for k in range(30))


def brute_copies(rows):
    """Components of all pairs of images that alike() calls copies."""
    seen = {i: image_copies.corners(image_copies.read_pgm(d)[None])[0] for i, d in rows if image_copies.read_pgm(d) is not None}
    label = {i: i for i, _ in rows}
    for a in seen:
        for b in seen:
            if a < b and label[a] != label[b] and image_copies.alike(seen[a], seen[b]):
                old, new = max(label[a], label[b]), min(label[a], label[b])
                label = {i: new if c == old else c for i, c in label.items()}
    return label


def test_image_copies_equal_brute_force(spark):
    rng = np.random.default_rng(4)
    wide = fields(rng, 1, 200)[0]
    rows = [(k, image_copies.write_pgm(x)) for k, x in enumerate(fields(rng, 20))]
    for k in range(100, 180):  # many crops of one large picture: few overlap with the first
        y, x, n = rng.integers(0, 110, 2).tolist() + [int(rng.integers(60, 90))]
        rows.append((k, image_copies.write_pgm(wide[y : y + n, x : x + n])))
    rows += [(k + 300, image_copies.write_pgm(EDITS["0.75"](image_copies.read_pgm(rows[k][1]), rng))) for k in range(0, 20, 3)]
    rows += [(400, rows[3][1]), (401, rows[3][1]), (402, b""), (403, None), (404, b"junk"), (405, image_copies.write_pgm(np.full((50, 50), 9.0)))]
    want = brute_copies(rows)
    df = spark.createDataFrame([(i, d, "x", 1) for i, d in [*rows, rows[0], rows[0], (None, rows[1][1])]], "media_id long, image binary, bucket string, k int")
    got = {r["id"]: r["component"] for r in image_copies.classes(df).collect()}
    assert got.keys() == want.keys()
    assert np.mean([got[i] == want[i] for i in got]) >= 0.95 and len({got[k] for k in range(100, 180)}) <= 4 and all(got[i] == i for i in (402, 403, 404, 405))
    assert image_copies.classes(df.limit(0)).count() == 0


def test_rendered_copies(spark):
    rng = np.random.default_rng(4)
    vectors = spark.createDataFrame([(k, rng.normal(size=32).tolist()) for k in range(40)] + [(90, None)], "vec_id long, embedding array<double>")
    got = {r["id"]: r["component"] for r in image_copies.classes(image_copies.rendered(vectors)).collect()}
    edits = [i for i in got if i < 0 and i != -91]
    assert edits and all(got[i] == got[-1 - i] for i in edits) and len({got[i] for i in range(40)}) == 40


@pytest.mark.parametrize("level", [2, 3])
def test_target_recall(level):
    n = near_duplicates.trees_for(level, 0.999)
    assert 1 - (1 - near_duplicates.survival(level)) ** n >= 0.999


def template(rng, count, frequent=30, own=25):
    shared = " ".join(f"f{k}" for k in range(frequent))
    return [(k, shared + " " + " ".join(rng.choice([f"w{j}" for j in range(900)], own))) for k in range(count)]


@pytest.mark.parametrize(("node", "group"), [(2048, 512), (8, 512), (2048, 16), (8, 4)])
def test_large_nodes_and_groups_equal_brute_force(spark, monkeypatch, node, group):
    monkeypatch.setattr(near_duplicates, "NODE", node)
    monkeypatch.setattr(near_duplicates, "GROUP", group)
    monkeypatch.setattr(near_duplicates, "PIVOTS", 3)
    rng = np.random.default_rng(8)
    base = [f"b{k}" for k in range(60)]
    rows = template(rng, 40)
    for k in range(100, 260):  # copies of one text, edited so that many pairs lie on both sides of the threshold
        w = list(base)
        for _ in range(rng.integers(1, 9)):
            w[rng.integers(len(w))] = f"e{rng.integers(500)}"
        rows.append((k, " ".join(w)))
    got = near_duplicates.classes(spark.createDataFrame(rows, "doc_id long, text string"), 2).collect()
    assert {r["id"]: (r["n"], r["component"]) for r in got} == brute_classes(rows)


def brute_recall(x, got, queries, k=5):
    u = x.astype(float) / np.linalg.norm(x.astype(float), axis=1, keepdims=True)
    hit = 0
    for q in queries:
        s = u @ u[q]
        s[q] = -9
        best = np.lexsort((np.arange(len(u)), -np.round(s, 12)))[:k]
        hit += len(set(best) & set(got[got.query_id == q].id))
    return hit / len(queries) / k


def test_neighbours_in_dense_groups_are_found(spark):
    # Groups far narrower than the codes' cells: all rows of a group look alike to the scan.
    rng = np.random.default_rng(5)
    x = np.repeat(rng.normal(size=(6, 64)), 700, 0)
    x = (x + rng.normal(0, 1e-3, x.shape)).astype(np.float32)
    df = spark.createDataFrame([(k, v.tolist()) for k, v in enumerate(x)], "vec_id long, embedding array<float>")
    got = neighbours.search(df, lambda i: i % 50 == 0).toPandas()
    assert brute_recall(x, got, range(0, len(x), 50)) >= 0.95


def test_fit_of_a_large_table_takes_little_memory():
    import tracemalloc

    rng = np.random.default_rng(6)
    x = rng.normal(size=(30_000, 4))
    tracemalloc.start()
    neighbours.fit(x / np.linalg.norm(x, axis=1, keepdims=True), 4 * 900**2, 5)  # 900 cells
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 120 << 20  # all distances at once would be 216 MB, and as much again for their sums
