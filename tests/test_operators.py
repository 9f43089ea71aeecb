import pytest
from pyspark.sql import functions as F

from siteweave.functions.coords import haversine_m
from siteweave.operators import crossmatch, geo, linkage, triage
from siteweave.sources import sinks

E_DDL = "pos long, sitio_id string, direccion_norm string, barrio string, lat double, lon double, coords_fuente string, consecutivo string"
V_DDL = E_DDL.replace("pos long, sitio_id", "visita_id")


def sides(spark, e, v):
    return linkage.prepare(spark.createDataFrame(v, V_DDL)), linkage.prepare(spark.createDataFrame(e, E_DDL))


def matched(v, e, **how):
    return {r["visita_id"]: (r["sitio_id"], r["match_method"]) for r in linkage.cascade(v, e, **how).collect()}


def test_cascade_order_and_empty(spark):
    e = [(0, "S0", "CL 5 # 4-3, Cali", "El Lido", 3.45, -76.53, "exif", "7"), (1, "S1", "KR 72 # 11-15, Cali", "Granada", None, None, None, "8")]
    v = [("V0", "CL 5 # 4-3, Cali", "El Lido", None, None, None, None), ("V1", "CL 11 CON KR 72", "Granada", None, None, None, None), ("V2", None, None, 3.45, -76.5301, "exif", None), ("V3", "x", "", None, None, None, "7"), ("V4", None, None, None, None, None, None)]
    left, right = sides(spark, e, v)
    assert matched(left, right) == {"V0": ("S0", "handshake"), "V1": ("S1", "corner"), "V2": ("S0", "geo"), "V3": ("S0", "preregistro"), "V4": (None, None)}
    assert matched(left, right.limit(0)) == {f"V{k}": (None, None) for k in range(5)}


def test_address_is_searched_once(spark, monkeypatch):
    e = [(k, f"S{k}", f"CL 5 # 4-{k + 1}, Cali", "Granada", None, None, None, None) for k in range(20)]
    v = [(f"V{k}", f"CL 5 # 4-30 APTO {k}, Cali", None if k % 2 else "Granada", None, None, None, None) for k in range(50)]
    left, right = sides(spark, e, v)
    seen, best = [], linkage._best
    monkeypatch.setattr(linkage, "_best", lambda df, *a, **k: seen.append(df.count()) or best(df, *a, **k))
    assert [tuple(r) for r in linkage.vector_block(left, right).select("sitio_id", "score").distinct().collect()] == [("S19", 10.0)]
    assert linkage.vector_block(left, right).count() == 50 and max(seen) <= 40
    assert matched(left, right, tiers=linkage.CHEAP) == {f"V{k}": ("S19", "vector_block") for k in range(50)} and max(seen) <= 40


def test_bridge_sees_a_spot_once(spark, monkeypatch):
    e = [(k, f"S{k}", None, ("Granada", "El Lido")[k % 2], 3.45, -76.53, "exif", None) for k in range(30)]
    v = [(f"V{k}", None, "El Lido" if k % 3 else None, 3.45, -76.53, "exif", None) for k in range(40)]
    left, right = sides(spark, e, v)
    seen, best = [], linkage._best
    monkeypatch.setattr(linkage, "_best", lambda df, *a, **k: seen.append(df.count()) or best(df, *a, **k))
    got = {r["visita_id"]: r["sitio_id"] for r in linkage.spatial_bridge(left, right).collect()}
    assert got == {f"V{k}": "S1" if k % 3 else "S0" for k in range(40)} and max(seen) <= 4


def test_geo_truncates_before_it_guards(spark):
    near = [(k, f"S{k}", f"CL {k + 20} # {k + 50}-1, Cali", "", 3.45 + k * 1e-5, -76.53, "exif", None) for k in range(3)]
    e = [*near, (3, "S3", "CL 5 # 4-3, Cali", "", 3.45 + 2e-4, -76.53, "exif", None)]
    left, right = sides(spark, e, [("V", "CL 5 # 4-99, Cali", "", 3.45, -76.53, "exif", None)])
    assert linkage.geo(left, right).count() == 0


def test_geo_key_margin(spark):
    e = [(0, "S0", None, "", 3.45, -76.53, "exif", None), (1, "S1", None, "", 3.45 + 95 / 111195, -76.53, "exif", None)]
    left, right = sides(spark, e, [("V", None, "", 3.45 - 10 / 111195, -76.53, "exif", None)])
    none = left.select("visita_id", F.lit(None).cast("string").alias("sitio_id"), F.lit(None).cast("string").alias("match_method"), F.lit(None).cast("double").alias("match_score"), F.lit(None).cast("double").alias("trust"))
    assert linkage.geo_key(none, left, right).first()["sitio_id"] == "S0"
    close = [*e[:1], (1, "S1", None, "", 3.45 + 10 / 111195, -76.53, "exif", None)]
    left, right = sides(spark, close, [("V", None, "", 3.45 - 10 / 111195, -76.53, "exif", None)])
    assert linkage.geo_key(none, left, right).first()["sitio_id"] is None


def test_near_join_is_brute_force(spark):
    pts = spark.range(400).select("id", (3.4 + (F.col("id") * 7919 % 400) / 1e5).alias("lat"), (-76.5 + (F.col("id") * 104729 % 400) / 1e5).alias("lon"))
    right = pts.select(F.col("id").alias("rid"), F.col("lat").alias("rlat"), F.col("lon").alias("rlon"))
    brute = pts.crossJoin(right).where(haversine_m(F.col("lat"), F.col("lon"), F.col("rlat"), F.col("rlon")) <= 60)
    got = geo.near_join(pts, right, 60.0)
    assert got.count() == brute.count() > 400 and got.select("id", "rid").exceptAll(brute.select("id", "rid")).count() == 0


def test_near_join_anywhere_on_the_globe(spark):
    import math
    import random

    rng = random.Random(9)
    spots = [(60.0, 10.0), (-75.0, 179.9995), (89.9995, 0.0), (0.0, -180.0), (3.4, -76.5)]
    made = lambda n: [(k, max(-90.0, min(90.0, y + rng.uniform(-0.004, 0.004))), (x + rng.uniform(-0.02, 0.02) * (9_000 if y > 89 else 1) + 180) % 360 - 180) for k, (y, x) in enumerate(rng.choice(spots) for _ in range(n))]
    one, two = made(300), made(300)

    def metres(a, b, c, d):
        a, b, c, d = map(math.radians, (a, b, c, d))
        return 2 * 6_371_000 * math.asin(math.sqrt(math.sin((c - a) / 2) ** 2 + math.cos(a) * math.cos(c) * math.sin((d - b) / 2) ** 2))

    want = {(i, j) for i, a, b in one for j, c, d in two if metres(a, b, c, d) <= 150}
    left, right = spark.createDataFrame(one, "i int, lat double, lon double"), spark.createDataFrame(two, "j int, rlat double, rlon double")
    got = [(r["i"], r["j"]) for r in geo.near_join(left, right, 150.0).collect()]
    assert len(got) == len(set(got)) and set(got) == want and len(want) > 300


def test_robust_centroid_drops_strays(spark):
    pts = spark.createDataFrame([("a", 3.45, -76.53), ("a", 3.45001, -76.53), ("a", 3.45, -76.53001), ("a", 3.49, -76.53), ("b", 3.4, -76.5)], "k string, lat double, lon double")
    got = {r["k"]: r for r in geo.robust_centroid(pts, "k").collect()}
    assert got["a"]["n"] == 3 and got["a"]["spread_m"] < 30 and got["b"]["spread_m"] == 0


def test_rounding_is_half_even(spark):
    row = spark.range(1).select(triage.demolition_score(F.lit(False), F.lit(40.0), F.lit(0.3)).alias("a"), triage.demolition_score(F.lit(False), F.lit(45.0), F.lit(0.3)).alias("b")).first()
    assert (row["a"], row["b"]) == (44.0, 50.0)


def test_text_analysis_negation(spark):
    docs = spark.createDataFrame([(1, "Grieta diagonal en muro. No se observa fisura"), (2, "sin grietas"), (3, None)], "k long, t string")
    terms = [("grieta", "grieta_generica", "patologia"), ("grietas? diagonal", "grieta_diagonal", "patologia"), ("fisura", "fisura_generica", "patologia"), ("muro", "muro_carga", "elemento")]
    got = {r["k"]: r for r in triage.analyse(docs, "k", "t", terms, {"grieta_diagonal": 0.7}, {"muro_carga": 1.0}, {"grieta_generica": ("grieta_diagonal",)}).collect()}
    assert got[1]["findings"] == ["grieta_diagonal"] and got[1]["gravity"] == 0.7 and got[2]["gravity"] == got[3]["gravity"] == 0


def test_short_id(spark):
    import hashlib

    n, out = int(hashlib.sha1(b"R1").hexdigest(), 16), ""
    while n:
        n, d = divmod(n, 36)
        out = "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZ"[d] + out
    assert spark.range(1).select(triage.short_id(F.lit("R1")).alias("x")).first()["x"] == out[:5]


def test_sinks_guard(spark, tmp_path):
    with pytest.raises(sinks.TargetError):
        sinks.overwrite(spark.range(1), "a", "b")
    with pytest.raises(sinks.TargetError):
        sinks.overwrite(spark.range(0), "a", "a")
    sinks.append_run(spark, {"ts": "1", "ok": True}, str(tmp_path / "runs"))
    assert sinks.read_runs(spark, str(tmp_path / "runs"), 5, "ts string, ok string").count() == 1


def test_zone_rollup_totals(spark):
    zones = spark.createDataFrame([("Z1",), ("Z2",)], "zona_id string")
    recs = spark.createDataFrame([("Z1", True), ("Z1", False), (None, True), ("Z9", False)], "zona_id string, hecho boolean")
    got = {r["zona_id"]: (r["n_total"], r["n_hechos"]) for r in crossmatch.zone_rollup(zones, recs).collect()}
    assert got == {"Z1": (2, 1), "Z2": (0, 0), "(fuera de zona)": (2, 1)}


def test_cascade_runs_all_tiers(spark):
    far = [(k, f"S{k}", f"CL {k + 20} # {k + 50}-1, Cali", "", 3.45 + k * 1e-5, -76.53, "exif", None) for k in range(3)]
    e = [*far, (3, "S3", "CL 5 # 4-3, Cali", "", 3.45 + 1e-4, -76.53, "exif", None), (4, "S4", "URBANIZACION LOS GUADUALES TORRE", "", None, None, None, None), (5, "S5", "CR", "", None, None, None, None)]
    v = [("bridge", "CL 5 # 9-99, Cali", "", 3.45, -76.53, "exif", None), ("text", "URBANIZACION LOS GUADUALES TORRES", "", None, None, None, None), ("emb", "ZZ QQ", "", None, None, None, None), ("none", "YY", "", None, None, None, None)]
    left, right = sides(spark, e, v)
    got = matched(left, right)
    assert got["bridge"] == ("S3", "spatial_bridge") and got["text"][0] == "S4" and got["text"][1] in ("tfidf", "fuzzy") and got["none"] == got["emb"] == (None, None)
    left = left.withColumn("emb", F.when(F.col("visita_id") == "emb", F.array(F.lit(1.0), F.lit(0.0))))
    right = right.withColumn("emb", F.when(F.col("sitio_id") == "S5", F.array(F.lit(1.0), F.lit(0.1))))
    assert matched(left, right) == {**got, "emb": ("S5", "embedding")}


def test_fuzzy_meets_all_sites(spark):
    import random

    from siteweave.functions.similarity import token_set

    rng = random.Random(4)
    words = ["CL", "KR", "5", "38", "120", "EDIFICIO", "EDIFICI0", "SIN", "NUMERO", "LIDO", "LIDOS", "GRANADA"]
    made = lambda: " ".join(rng.choice(words) for _ in range(rng.randrange(7)))
    sites, asked = [(k, made()) for k in range(300)], sorted({made() for _ in range(60)})
    brute = [(t, pos, -r) for t in asked for r, pos in sorted((-token_set(t, s), pos) for pos, s in sites if token_set(t, s) >= 88)[:5]]
    from siteweave.operators.similar import set_search

    texts, held = spark.createDataFrame([(t,) for t in asked], "t string"), spark.createDataFrame(sites, "pos long, t string")
    got = sorted((r["key_text"], -r["ratio"], r["pos"]) for r in set_search(texts, held, token_set, 88.0, 5).collect())
    assert len(brute) > 50 and [(t, pos, -r) for t, r, pos in got] == brute
    e = [(0, "S0", "CL 38 # 120-5, Cali", "", None, None, None, None), (1, "S1", "PARQUEADERO LOS GUADUALES, Cali", "", None, None, None, None)]
    left, right = sides(spark, e, [("V", "PARQUEADEROS LOS GUADUALES, Cali", "", None, None, None, None)])
    assert [r["sitio_id"] for r in linkage.fuzzy(left, right).collect()] == ["S1"]
