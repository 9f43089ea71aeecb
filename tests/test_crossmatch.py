from difflib import SequenceMatcher
from random import Random

import pytest
from pyspark.sql import functions as F

from siteweave.functions.coords import haversine_m
from siteweave.functions.similarity import difflib_ratio
from siteweave.operators import crossmatch


def test_by_address_equals_all_pairs(spark):
    rng = Random(3)
    street = lambda: f"CL {rng.randint(1, 12)}{rng.choice(['', 'A', ' N'])} # {rng.randint(1, 4)}-{rng.randint(1, 30)}"
    place = lambda: (3.4 + rng.random() * 0.004, -76.5 + rng.random() * 0.004) if rng.random() < 0.8 else (None, None)
    streets = [street() for _ in range(120)]
    typed = lambda: rng.choice(streets) + rng.choice(["", " APTO 3", "1", " LOCAL", ""]) if rng.random() < 0.9 else rng.choice(["", "EDIFICIO"])
    v = spark.createDataFrame([(f"V{k}", typed(), *place()) for k in range(300)], "visita_id string, akey string, lat double, lon double")
    s = spark.createDataFrame([(k, typed(), *place()) for k in range(250)], "pos long, rkey string, rlat double, rlon double")
    d = {(r[0], r[1]): r[2] for r in v.crossJoin(s).select("visita_id", "pos", haversine_m(F.col("lat"), F.col("lon"), F.col("rlat"), F.col("rlon"))).collect()}
    digits = lambda t: " ".join("".join(c if c.isdigit() else " " for c in t).split(" ")).split()
    want = {}
    sites = s.collect()
    for r in v.collect():
        best = []
        for t in sites if r.akey else ():
            a, b, m = r.akey, t.rkey, d[r.visita_id, t.pos]
            close = lambda x: m is not None and m <= x  # noqa: B023, E731
            if not b:
                continue
            ratio = SequenceMatcher(None, a, b).ratio()
            if a == b:
                best.append((0, 0, t.pos))
            elif min(len(a), len(b)) >= 8 and (a.startswith(b) or b.startswith(a)) and close(150):
                best.append((1, 0, t.pos))
            elif ratio >= 0.9 and (digits(a) == digits(b) or close(150)):
                best.append((2, -ratio, t.pos))
            elif ratio >= 0.85 and close(60):
                best.append((3, -ratio, t.pos))
        if best:
            want[r.visita_id] = (min(best)[2], "combinado" if min(best)[0] in (1, 3) else "direccion")
    rows = crossmatch.by_address(v, s, "visita_id").collect()
    got = {r.visita_id: (r.pos, r.via) for r in rows}
    assert len(rows) == len(got) and got == want and len({x[1] for x in got.values()}) == 2


def test_ratios_below_the_floor_need_no_matching(spark):
    df = spark.createDataFrame([("CL 5 # 3-4", "CL 5 # 3-44", 0.9), ("CL 5 # 3-4", "AV 61 N # 72", 0.9), ("abc", "cba", 0.85)], "a string, b string, least double")
    got = df.select(difflib_ratio("a", "b").alias("x"), crossmatch.difflib_ratio_from(F.col("a"), F.col("b"), F.col("least")).alias("y")).collect()
    assert got[0].x == got[0].y and got[1].y == 0.0 and got[2].y == pytest.approx(got[2].x)


def test_address_keys_name_each_rule_once(spark):
    from siteweave.functions import text

    typed = ["Calle 5 No. 3-4, barrio x", "", "-", None, " Cra. 7 Norte # 8 N - 9", "AV. 3 NTE , Cali, Valle", ",x"]
    df = spark.createDataFrame([(t,) for t in typed], "a string")
    got = df.select(text.addr_key(F.col("a")).alias("k"), text._street(text.normalize_address(F.col("a"))).alias("s")).select("k", F.trim(text._sub(text._sub(text._all(F.col("s"), text.COMPASS), r"(\d)\s+([NOSE])\b", "$1$2"), r"\s+", " ")).alias("w")).collect()
    assert all(r.k == r.w for r in got)
    assert df.select(text.addr_key(F.col("a")))._jdf.queryExecution().optimizedPlan().toString().count("CARRETERA") <= 2
