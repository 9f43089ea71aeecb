"""Rules that no query shows, on small tables."""

import json

import pytest
from pyspark.sql import functions as F

from siteweave.functions import text
from siteweave.operators import crossmatch, earlier
from siteweave.sources import exports, loaders, readers, sinks


def test_geocoder_query(spark):
    rows = ["KR 42 # 5-25, Urbanización Tequendama, Cali", "CL 1D OESTE 100 BIS 33 TORRE 85, Altos De Santa Helena, Cali", "KR 67 CON CL 3 C, Urbanización El Refugio, Cali", "", "-", None]
    df = spark.createDataFrame([(k, r) for k, r in enumerate(rows)], "k int, s string")
    got = [r[0] for r in df.orderBy("k").select(text.geocoder_query(F.col("s"))).collect()]
    assert got[0] == "Carrera 42 # 5-25, Urbanización Tequendama, Cali, Valle del Cauca, Colombia" and got[3:] == ["", "", ""]
    assert got[1].startswith("Calle 1D OESTE 100 BIS 33") and "TORRE" not in got[1] and "Altos De Santa Helena" in got[1]
    assert got[2].startswith("Carrera 67 CON Calle 3 C") and "Urbanización El Refugio" in got[2]


def test_number_agreement(spark):
    rows = [("CL 5 # 4-3", "CL 5 # 4-40"), ("CL 5 # 4-3", "CL 5 # 4-90"), ("CL 5A # 4-3", "CL 5 # 4-3"), ("KR 5 # 4-3", "CL 5 # 4-3"), ("", "CL 5 # 4-3"), (None, None)]
    df = spark.createDataFrame([(k, *r) for k, r in enumerate(rows)], "k int, a string, b string")
    got = [r[0] for r in df.orderBy("k").select(earlier.number_agreement(text.address_vector(F.col("a")), text.address_vector(F.col("b")))).collect()]
    assert got == [1.0, 0.0, 1.0, 0.0, 0.0, 0.0]


def test_zones_of_a_map(spark, tmp_path):
    mark = lambda name, points: f"<Placemark><name>{name}</name><description>ola: 1&lt;br&gt;comuna: 17</description><Polygon><outerBoundaryIs><LinearRing><coordinates>{points}</coordinates></LinearRing></outerBoundaryIs></Polygon></Placemark>"
    body = f"<Folder><name>Zonas F3</name>{mark('Z1', '-76.5,3.4,0 -76.4,3.4,0 -76.4,3.5,0')}{mark('Z2', '-76.5,3.4,0 -76.4,3.4,0')}<Placemark><name>P</name><description>x</description></Placemark></Folder><Folder><name>otros</name>{mark('Z3', '0,0,0 1,0,0 1,1,0')}</Folder>"
    (tmp_path / "z.kml").write_text(f"<kml><Document>{body}</Document></kml>")
    got = readers.kml_zones(spark, str(tmp_path / "z.kml")).collect()
    assert [(r["id"], [(p["x"], p["y"]) for p in r["rings"][0]]) for r in got] == [("Z1", [(-76.5, 3.4), (-76.4, 3.4), (-76.4, 3.5)])]
    told = spark.createDataFrame([(got[0]["description"],)], "d string")
    assert told.select(*(c.alias(n) for n, c in readers.described(F.col("d")).items())).head().asDict() == {"ola": "1", "despacho": "", "comuna": "17", "barrios": "", "carga": ""}


def test_surveys_inspections_and_the_manager(spark, tmp_path):
    surveys = spark.createDataFrame([("{ABC}", "-76.5", "3.4", "Calle 5 # 4-3", ""), ("{D}", "x", "3.4", "", "")], "GlobalID string, x string, y string, direccion string, direccion_norm string")
    got = loaders.load_survey(surveys).collect()
    assert [(r["gid"], r["rlat"], r["rlon"], r["direccion"], r["fecha"]) for r in got] == [("abc", 3.4, -76.5, "Calle 5 # 4-3", None)]
    page = {"features": [{"attributes": {"globalid": "{A-1}", "fecha_inspeccion": 1786000000000, "nombre_evaluador": "e"}, "geometry": {"x": -76.5, "y": 3.4}}]}
    (tmp_path / "p.json").write_text(json.dumps(page))
    assert [tuple(r) for r in loaders.load_inspections(spark.read.json(str(tmp_path / "p.json"))).collect()] == [("a-1", 3.4, -76.5, "2026-08-06", "e")]
    (tmp_path / "q.json").write_text(json.dumps({**page, "error": {"code": 1}}))
    with pytest.raises(ValueError, match="error"):
        loaders.load_inspections(spark.read.json(str(tmp_path / "q.json")))
    for name, rows in {"zonas": [{"ZONA_ID": 7, "N_PUNTOS": 3}], "evaluaciones": [{"GLOBAL_ID": "g", "X": "-76.5", "Y": "3.4"}], "puntos": [{"ZONA_ID": 7, "LAT": 3.4, "LON": "?"}], "despachosHoy": [{"ZONA_ID": 7}]}.items():
        (tmp_path / f"{name}.json").write_text(json.dumps(rows))
    m = {k: d.head().asDict() for k, d in loaders.load_manager(spark, str(tmp_path)).items()}
    assert (m["zonas"]["zona_id"], m["zonas"]["n_puntos"], m["zonas"]["poligono"]) == ("7", "3", None) and (m["evaluaciones"]["rlat"], m["evaluaciones"]["rlon"]) == (3.4, -76.5)
    assert (m["puntos"]["rlat"], m["puntos"]["rlon"]) == (3.4, None) and m["despachosHoy"]["zona_id"] == "7"


def test_reports_ids_and_done_records(spark, tmp_path):
    exports.save_report({"metrics": spark.sql("SELECT 1 AS n, CAST(NULL AS STRING) AS x")}, str(tmp_path / "report"))
    (part,) = (tmp_path / "report" / "metrics").glob("part-*.json")
    assert json.loads(part.read_text()) == {"n": 1, "x": None}
    current = spark.createDataFrame([("a", ""), ("b", "OLD1"), ("c", None)], "k string, id string")
    run = spark.createDataFrame([("a", "NEW1"), ("b", "OLD1")], "k string, id string")
    assert sorted(sinks.fill_missing_ids(current, run, "k", "id").select("k", F.coalesce("id", F.lit("-"))).collect()) == [("a", "NEW1"), ("b", "OLD1"), ("c", "-")]
    with pytest.raises(sinks.TargetError):
        sinks.fill_missing_ids(current, run.union(spark.createDataFrame([("z", "LOST")], run.schema)), "k", "id")
    pairs = spark.createDataFrame([("R1-1", "geo"), ("R1-2", "geo"), ("R2-1", ""), ("", "solo_f3")], "registro_id string, match_method string")
    assert [r[0] for r in crossmatch.done_records(pairs).collect()] == ["R1"]
    points = spark.createDataFrame([("V1", 2, 4.0), ("V2", 3, 8.0)], "visita_id string, n long, spread_m double")
    info = loaders.harvest_info(points, points.limit(1))
    assert info.head().asDict() == {"visitas_con_gps": 2, "fotos_gps_usadas": 5, "dispersion_mediana_m": 6.0, "omitidas_por_confiables": 1}
    assert loaders.harvest_info(points.limit(0), points.limit(0)).head().asDict() == {"visitas_con_gps": 0, "fotos_gps_usadas": 0, "dispersion_mediana_m": None, "omitidas_por_confiables": 0}
