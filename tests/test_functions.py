import pytest
from pyspark.sql import functions as F

from siteweave.functions import coords, similarity, text
from siteweave.sources.readers import fill_ids, id_sequence, new_ids, recover_header


def values(spark, column, rows):
    df = spark.createDataFrame([(k, r) for k, r in enumerate(rows)], "k int, s string")
    return [r[0] for r in df.orderBy("k").select(column(F.col("s"))).collect()]


def test_normalize_address(spark):
    got = values(spark, text.normalize_address, ["Calle 80 No. 45-23", "Kra 10 Num 15-20", "CR 4 # 5-6", "Cl 5 # 4-3, barrio el LIDO", None, "-", ""])
    assert got == ["CL 80 # 45-23", "KR 10 # 15-20", "KR 4 # 5-6", "CL 5 # 4-3, Barrio El Lido", "", "-", ""]


def test_handshake_and_canonical(spark):
    assert values(spark, text.handshake, ["CL 5 # 43A-15, El Lido, Cali", "KR 72 CON CL 11, La Hacienda", None]) == ["CL5#43A-15", "KR72", ""]
    got = values(spark, text.canonical, ["KR 60A # 11B-31 APTO 203B, Santa Anita", "AV 5 NORTE # 22-40", "AV 4TA NORTE # 7N-53", "KR 4A # 1-2"])
    assert got == ["KR 60A # 11B-31", "AV 5N # 22-40", "AV 4N # 7N-53", "KR 4A # 1-2"]


def test_vector_and_corner(spark):
    vec = lambda c: F.struct(text.address_vector(c).alias("v"), text.corner_key(text.canonical(c), text.address_vector(c)).alias("k"))
    a, b, c, bis, none = values(spark, vec, ["KR 72 CON CL 11", "CL 11 # 72-15", "KR 60A # 11B-31", "CL 5 BIS # 4-3", "-"])
    assert a["k"] == b["k"] == [11.0, 72.0]
    assert c["v"]["road"] == pytest.approx(2060.01, abs=1e-3) and c["v"]["cross"] == pytest.approx(11.02, abs=1e-5) and c["v"]["plate"] == 31
    assert bis["v"]["road"] == pytest.approx(1005.5) and tuple(none["v"]) == (0, 0, 0) and none["k"] is None


def test_small_text_rules(spark):
    assert values(spark, text.consecutive_key, ["No", "N.A", "0", "00", "13-33", " 563 ", None]) == ["", "", "", "", "", "563", ""]
    assert values(spark, text.district, ["19", "comuna19", "El Saladito"]) == ["Comuna 19", "Comuna 19", "El Saladito"]
    assert values(spark, text.addr_key, ["Calle 1 No. 2-3, Cali", "CL 63 NORTE # 3EN-60"]) == ["CL 1 # 2-3", "CL 63N # 3EN-60"]
    assert values(spark, text.folder_address, ["28. Calle 9 & Carrera 18", "1) L2 (Cl 3D KR 67)", "Fotogrametria"]) == ["Calle 9 con Carrera 18", "Cl 3D KR 67", ""]
    assert values(spark, text.title_case, ["san-juan 43a ÁVILA"]) == ["San-Juan 43A Ávila"]
    assert values(spark, text.spoken_address, ["CL 5N # 4-3"]) == ["CALLE 5 NORTE NUMERO 4 3"]


def test_parse_coords(spark):
    rows = ["3°25'12.5\" N, 76°32'10\" W", "3°25'12.5\" N, 76°32'10\" O", "3,4910915, -76,5191746", "https://x/?q=3.45,-76.53", "-76.53 3.45", "sin dato", None]
    got = values(spark, coords.parse_coords, rows)
    assert got[0] == got[1] and got[0]["lon"] == pytest.approx(-(76 + 32 / 60 + 10 / 3600))
    assert got[2]["lat"] == pytest.approx(3.4910915) and tuple(got[3]) == (3.45, -76.53) == tuple(got[4]) and got[5] is None and got[6] is None


def test_planar_origin(spark):
    got = values(spark, coords.from_planar, ["1000000.0 1000000.0", "1061000 871000"])
    assert got[0]["lat"] == pytest.approx(4.5962004, abs=1e-5) and got[0]["lon"] == pytest.approx(-77.0775079, abs=1e-5)
    assert 3 < got[1]["lat"] < 4 and -77 < got[1]["lon"] < -76


def test_similarity():
    assert similarity.token_sort("fuzzy was a bear", "a bear fuzzy was") == 100
    assert similarity.token_set("CL 5 # 4-3", "CL 5 # 4-3 EL LIDO") == 100
    assert similarity.indel_ratio("", "") == 100 and similarity.token_set("", "a") == 0
    assert similarity.jaro_winkler("martha", "marhta") == pytest.approx(0.961111, abs=1e-6)
    assert similarity.damerau("ca", "abc") == 2


def test_ids_and_headers():
    ids = id_sequence(500, 42)
    assert len(set(ids)) == 500 and not any(i.isdigit() for i in ids) and ids == id_sequence(500, 42)
    assert recover_header(["Zona", "", "Tipo"]) == ["Zona", "Barrio", "Tipo"] and recover_header(["", "Tipo"]) == ["", "Tipo"]


def test_ids_end_with_their_space():
    assert sorted(id_sequence(26, 1, {"7", "xx"}, 1)) == [chr(65 + k) for k in range(26)]
    assert len(set(id_sequence(25, 1, {"A", "7"}, 1)) - {"A"}) == 25
    with pytest.raises(ValueError, match="25 are free"):
        id_sequence(26, 1, {"A", "7"}, 1)
    assert len(id_sequence(36**3 - 1000 - 100, 2, length=3)) == 36**3 - 1100


def test_ids_without_the_driver(spark):
    given = [(k, ["", "  ", None, f"T{k:03d}", "Q0Q0", "1234"][k % 6]) for k in range(300)]
    df = spark.createDataFrame(given, "k long, id string").repartition(4)
    taken = {i for _, i in given if i and i.strip()}
    blanks = [k for k, i in given if not (i or "").strip()]
    got = {r["k"]: r["id"] for r in fill_ids(df, "id", "k", 42).collect()}
    assert [got[k] for k in blanks] == id_sequence(150, 42, taken) and all(got[k] == i for k, i in given if k not in blanks)
    far = {r["k"]: r["id"] for r in fill_ids(df, "id", "k", 42, drawn=10).collect()}
    new = [far[k] for k in blanks]
    assert len(set(new)) == 150 and not set(new) & taken and all(len(i) == 4 and not i.isdigit() for i in new)
    assert far == {r["k"]: r["id"] for r in fill_ids(df.repartition(3), "id", "k", 42, drawn=10).collect()}
    none = spark.createDataFrame([("A",), ("7",)], "_id string")
    for drawn in (0, 100):
        assert {r["_id"] for r in new_ids(spark, 25, none, 1, 1, drawn).collect()} == set("BCDEFGHIJKLMNOPQRSTUVWXYZ")
        with pytest.raises(ValueError, match="25 are free"):
            new_ids(spark, 26, none, 1, 1, drawn)
    whole = [r["_id"] for r in new_ids(spark, 36**3 - 1100, none.limit(0), 5, 3, 0).collect()]
    assert len(set(whole)) == 36**3 - 1100
