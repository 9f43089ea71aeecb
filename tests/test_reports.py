"""Rosters, proposals, reports, loaders, sinks and streams on small tables."""

import pytest
from pyspark.sql import functions as F

from siteweave.operators import calibrated, earlier, linkage, order, proposals, reports, roster, triage
from siteweave.shared import written
from siteweave.sources import exports, loaders, readers, sinks
from siteweave.streaming import state

TERMS = [(r"grietas?\s+diagonal(?:es)?", "grieta_diagonal", "patologia"), ("grietas?", "grieta_generica", "patologia"), (r"muros?\s+de\s+carga", "muro_carga", "elemento"), ("columnas?", "columna", "elemento"), (r"demoler|demolici[oó]n", "demoler", "accion")]
WEIGHT, CRITICAL = {"grieta_diagonal": 0.7, "grieta_generica": 0.25}, {"muro_carga": 1.0, "columna": 1.0}
SUPERSEDE = {"grieta_generica": ("grieta_diagonal",)}


def test_findings(spark):
    texts = ["Se observan grietas diagonales en muros de carga. Se recomienda demolicion", "no se requiere por ahora demolicion", "sin grietas", "grietas", "", None, "no hay, grietas en columna", "ni una sola de las muchas largas grietas"]
    got = {r["k"]: r for r in triage.findings(spark.createDataFrame(list(enumerate(texts)), "k int, t string"), "k", "t", TERMS, WEIGHT, CRITICAL, SUPERSEDE, {"grieta_diagonal": "AIS-manual 3"}).collect()}
    assert [tuple(f) for f in got[0]["findings"]] == [("grieta_diagonal", "muro_carga", "AIS-manual 3")] and got[0]["gravity"] == 0.7 and got[0]["actions"] == ["demoler"]
    assert got[1]["actions"] == [] and got[2]["findings"] == [] and got[3]["gravity"] == 0.15 and got[4]["gravity"] == got[5]["gravity"] == 0.0
    assert got[6]["gravity"] == 0.25 and got[7]["gravity"] == 0.15


def test_demolition_proposals(spark):
    names = ["id_edan", "colapso_total", "criterio_habitabilidad", "colapso_parcial", "danos_estructura", "severidad_danos", "severidad_danos_calc", "inclinacion_importante", "asentamiento_severo", "danos_contrapiso_entrepiso_muroscont", "estado_edificacion", "recomendaciones", "eval_estructural", "observaciones_generales"]
    hard = dict(colapso_total="no", criterio_habitabilidad="i2", colapso_parcial="si", danos_estructura="severo")
    rows = [
        dict(id_edan="AAA01", colapso_total="si", criterio_habitabilidad="i2"), {**hard, "id_edan": "BBB02", "criterio_habitabilidad": "h", "severidad_danos": "alto"},
        {**hard, "id_edan": "CCC03", "severidad_danos": "alto", "inclinacion_importante": "si", "asentamiento_severo": "si", "danos_contrapiso_entrepiso_muroscont": "severo", "estado_edificacion": "malo"},
        dict(id_edan="DDD04", colapso_total="no", criterio_habitabilidad="i2", danos_estructura="moderado", severidad_danos="medio"), {**hard, "id_edan": "EEE05", "criterio_habitabilidad": "i3", "severidad_danos_calc": "medio"},
        {**hard, "id_edan": "FFF06", "severidad_danos": "medio", "recomendaciones": "evacuar_total,monitoreo, demoler"}, {**hard, "id_edan": "GGG07", "severidad_danos": "medio", "observaciones_generales": "no se requiere por ahora demolicion"},
        {**hard, "id_edan": "HHH08", "severidad_danos": "medio", "eval_estructural": "Grietas diagonales en muros de carga. Se recomienda demolicion de la edificacion"},
        dict(id_edan="III09", colapso_total="no", criterio_habitabilidad="i3", danos_estructura="moderado", severidad_danos="alto", inclinacion_importante="si", asentamiento_severo="si", danos_contrapiso_entrepiso_muroscont="severo", estado_edificacion="malo", eval_estructural="Se recomienda demolicion de la edificacion"),
    ]
    df = spark.createDataFrame([tuple(r.get(n) for n in names) for r in rows], ", ".join(f"{n} string" for n in names))
    how = (TERMS, WEIGHT, CRITICAL, SUPERSEDE, {"grieta_diagonal": "AIS-manual 3"}, "2026-08-16 12:00")
    got = proposals.proposals(df, *how).orderBy("prioridad").collect()
    assert [(r["id_edan"], r["score"], r["categoria"]) for r in got] == [("AAA01", 100, "demolicion_inmediata"), ("CCC03", 95, "demolicion_probable"), ("FFF06", 70, "demolicion_prioritaria"), ("HHH08", 70, "demolicion_prioritaria")]
    assert "5.7 dano estructural severo" in got[1]["motivos"] and "recomendacion explicita: demoler" in got[2]["motivos"] and got[3]["hallazgos_texto"] == "grieta_diagonal@muro_carga [AIS-manual 3]"
    three = spark.createDataFrame([("AAA01", "R1-AAA01"), ("FFF06", "R2-FFF06; R2-XTRA9")], "edan_id string, registros string")
    kept = {r["id_edan"]: r["registro_id"] for r in proposals.proposals(df, *how, three=three).collect()}
    assert kept == {"AAA01": "R1-AAA01", "FFF06": "R2-FFF06; R2-XTRA9"} and proposals.proposals(df.limit(0), *how).count() == 0


def test_roster(spark):
    zone = [(0, "Z1", "1", "D1", [[(-76.53, 3.43), (-76.51, 3.43), (-76.51, 3.45), (-76.53, 3.45)]])]
    zones = spark.createDataFrame(zone, "pos long, zona_id string, ola string, despacho string, rings array<array<struct<x:double,y:double>>>")
    rows = [("R1", "arcgis:{ABC}", "V1", 3.44, -76.52, "", "Riesgo alto", "grieta", "1", "0", "", "si"), ("R2", "", "V2", None, None, "3.440200, -76.520000", "", "", "0", "0", "0", ""), ("R3", "", "V3", 3.60, -76.60, "", "", "", "", "", "", ""), ("R4", "", "V4", None, None, "sin dato", "", "", "", "", "", "")]
    records = spark.createDataFrame(rows, "registro_id string, sitio_id string, visita_id string, lat double, lon double, coords_unificadas string, nivel_riesgo string, descripcion_visita string, n_fallecidos_total string, n_atrapamientos_total string, n_rescatados_total string, requiere_demolicion string")
    times = spark.createDataFrame([("V1", "2026-08-10 12:00:00"), ("V2", "2026-08-14 12:00:00")], "visita_id string, t string").select("visita_id", F.col("t").cast("timestamp").alias("ts"))
    seen = spark.createDataFrame([("abc", 3.0, -76.0, "2026-08-14"), ("near", 3.4404, -76.52, "2026-08-15")], "gid string, rlat double, rlon double, fecha string")
    terms = spark.createDataFrame([("grieta", 0.7)], "pattern string, weight double")
    done = spark.createDataFrame([("R3",)], "registro_id string")
    got = roster.checked(roster.assignments(records, done, times, "2026-08-16 12:00:00", terms, zones, seen))
    assert got.columns == [*roster.PUBLISHED, *roster.WEB]
    got = {r["registro_id"]: r for r in got.collect()}
    assert got.keys() == {"R1", "R2", "R3"} and (got["R1"]["prioridad"], got["R2"]["prioridad"], got["R3"]["prioridad"]) == (1, 2, None)
    # 30 * 0.7 + 25 * (1 - 0.6 ** 3) + 20 * 1 + 10 + 10 + 5
    assert got["R1"]["score"] == pytest.approx(85.6) and got["R1"]["zona_id"] == "Z1" and got["R3"]["flags"] == "fuera_de_zona,sin_timestamp" and got["R2"]["antiguedad_dias"] == 2.0
    assert [got[r]["ede_match"] for r in ("R1", "R2", "R3")] == ["globalid", "cercania", None] and got["R2"]["ede_dist_m"] == 22 and got["R1"]["ede_fecha"] == "2026-08-14"
    blind = roster.assignments(records, done, times, "2026-08-16 12:00:00", terms)
    one = roster.counters(blind).head()
    assert (one["filas"], one["pendientes"], one["visitados"], one["ede_hechas"]) == (3, 2, 1, None) and roster.assignments(records, done, times, "2026-08-16 12:00:00", terms, top=1).count() == 2


def test_survey_cascade(spark):
    survey = spark.createDataFrame([(0, "g1", 3.40, -76.50, "CL 1 # 2-3"), (1, "g2", 3.42, -76.52, "KR 10 # 15-20 EL LIDO"), (2, "g3", 3.45, -76.53, "AV 5N # 22-40")], "pos long, gid string, rlat double, rlon double, rkey string").withColumns({"fecha": F.lit("f"), "evaluador": F.lit("e")})
    rows = [("A", "arcgis:{G3}", "", ""), ("B", "x", "3.420100, -76.520000", "otra"), ("C", "", "3.300000, -76.400000", "Calle 1 No. 2-3, Cali"), ("D", "", "3.420900, -76.520000", "Kra 10 Num 15-20"), ("E", "", "3.300000, -76.400000", "CL 99 # 99-99"), ("F", "", "", "")]
    critical = spark.createDataFrame(rows, "registro_id string, sitio_id string, coords_unificadas string, direccion_unificada string")
    out = reports.survey_cross(critical, survey)
    got = {r["registro_id"]: (r["match"], r["survey_globalid"]) for r in out.collect()}
    assert got == {"A": ("globalid", "g3"), "B": ("cercania", "g2"), "C": ("direccion", "g1"), "D": ("combinado", "g2"), "E": (None, None), "F": (None, None)}
    assert reports.survey_summary(out, survey).head().asDict() == {"total_criticos": 6, "levantados": 4, "pendientes": 2, "por_globalid": 1, "por_cercania": 1, "por_direccion": 1, "por_combinado": 1, "survey_usados": 3, "survey_puntos": 3}
    assert reports.survey_rollup(out).head()["n_criticos"] == 6 and reports.survey_cross(critical.limit(0), survey).count() == 0


def test_manager_cross(spark):
    zones = spark.createDataFrame([(0, "Z1", "C1", "L", "A", "4", "[[3.40,-76.53],[3.40,-76.51],[3.42,-76.51],[3.42,-76.53]]"), (1, "Z2", "C2", "L", "A", None, "junk"), (2, "", "", "", "", "", None)], "pos long, zona_id string, comuna string, lider string, estado string, n_puntos string, poligono string")
    evaluations = spark.createDataFrame([(0, "G0", "f", "s", "h", 3.41, -76.52, "CL 9 # 9-9"), (1, "G1", "f", "s", "h", None, None, "KR 1 # 2-3")], "pos long, global_id string, fecha string, severidad string, habitabilidad string, rlat double, rlon double, direccion string")
    points = spark.createDataFrame([(0, "Z1", "pendiente", 3.41, -76.52), (1, "Z1", "CERRADO", 3.5, -76.5)], "pos long, zona_id string, estado string, rlat double, rlon double")
    asked = spark.createDataFrame([("A", 3.4101, -76.52, "x", "Z2"), ("B", None, None, "Carrera 1 No 2-3", "Z2"), ("C", 3.7, -76.7, "zz", "Z9"), ("D", None, None, "", None)], "registro_id string, lat double, lon double, direccion string, zona_id string")
    crossed = reports.manager_cross(asked, zones, evaluations, points)
    got = {r["registro_id"]: (r["zona_id"], r["zona_via"], r["f3_match_via"], r["punto_estado"]) for r in crossed.collect()}
    assert got == {"A": ("Z1", "poligono", "geo", "pendiente"), "B": ("Z2", "roster", "direccion", None), "C": ("Z9", "roster", None, None), "D": (None, None, None, None)}
    today = spark.createDataFrame([("Z1",), (None,)], "zona_id string")
    roll = {r["zona_id"]: (r["n_criticos"], r["n_f3_hechas"], r["despacho_hoy"], r["gestor_pendientes"], r["gestor_n_puntos"]) for r in reports.manager_rollup(zones, crossed, today, points).collect()}
    assert roll == {"Z1": (1, 1, True, 1, 4), "Z2": (1, 1, False, 0, 0), "(fuera de zona)": (2, 0, False, 0, 0)}
    one = reports.manager_summary(crossed, points, today).head()
    assert one["total_criticos"] == sum(n for n, *_ in roll.values()) and one["f3_por_direccion"] == 1 and one["zonas_con_despacho_hoy"] == 1


def test_inspections_through_the_cascade(spark):
    r = spark.createDataFrame([("R1", "S1", "V1", "CL 5 # 43A-15, Cali", "El Lido", "", ""), ("R2", "S2", "V2", "KR 10 # 15-20, Cali", "San Fernando", "", ""), ("R3", "S3", "V3", "", "", "", "3.440000, -76.520000")], "registro_id string, sitio_id string, visita_id string, direccion_unificada string, barrio_unificado string, comuna_unificada string, coords_unificadas string").withColumns({"tipo_estructura_edan": F.lit(""), "tipo_estructura_visita": F.lit("casa")})
    f = spark.createDataFrame([("E1", "CL 5 # 43A-15, Cali", "El Lido", "", ""), ("E2", "", "", "", "3.440100, -76.520000"), ("E3", "DG 80 # 90-91, Cali", "Otro", "", "")], "id_edan string, direccion_norm string, barrio_vereda string, comuna string, coords string").withColumn("uso_edificacion", F.lit("hotel"))
    got = {(x["registro_id"], x["edan_id"], x["match_method"]) for x in reports.inspection_cascade(r, f, linkage.cascade, linkage.prepare).collect()}
    assert got == {("R1-E1", "E1", "handshake"), ("R2", "", ""), ("R3-E2", "E2", "geo"), ("", "E3", "solo_f3")}


def test_cases_have_all_columns(spark, tmp_path):
    import json

    case = {"id": 7, "estadoEtiqueta": "Visitado", "direccion": "CL 1", "lat": 3.4, "lng": -76.5, "placeId": "p", "comuna": 19, "resumenUnidad": "apto", "inmueble": {"tipoInmuebleEtiqueta": "casa"}, "evaluacion": {"id": "e1", "creado_utc": 5, "tipoColapso": "A", "victimas": {"fallecidos": 2}}}
    newer = {**case, "evaluacion": {**case["evaluacion"], "id": "e2", "creado_utc": 9, "tipoColapso": "B", "tipoInmuebleEtiqueta": "hotel"}}
    bare = {"id": 8}
    (tmp_path / "c.json").write_text("\n".join(map(json.dumps, (case, newer, bare))))
    got = loaders.flat_cases(loaders.fetch_cases(spark, str(tmp_path)))
    assert tuple(got.columns) == loaders.CASE_COLUMNS and len(got.columns) == 21
    got = {r["registro_id"]: r for r in got.collect()}
    assert (got["7"]["visita_id"], got["7"]["tipo_estructura_visita"], got["7"]["requiere_demolicion"], got["7"]["comuna_unificada"], got["7"]["coords_unificadas"], got["7"]["nombre_estructura"], got["7"]["n_fallecidos_total"]) == ("e2", "hotel", "", "19", "3.400000, -76.500000", "apto", "2")
    assert set(got["8"].asDict().values()) == {"8", "", "api_visitados_criticos"} and loaders.fetch_cases(spark, str(tmp_path), 6, 9).count() == 1


def test_sheets_are_loaded(spark):
    names = ["ID", "Prioridad", "Estado", "Zona", "-", "Tipo", "DIRECCION COMPLETA", "Descripción", "Personas Evacuadas", "Daños", "COORDENADAS", "Color semaforo", "sitio_id"]
    raw = spark.createDataFrame([("1", "ALTA", "x", "z", "El Lido", "casa", "calle 5 no. 43a-15", "d", "3", "1", "3,4910915, -76,5191746", "r", ""), ("2", "", "ANULADO", "", "", "", "x", "", "", "", "", "", "AB12"), ("3", "-", "", " ", "", "", "", "", "", "", "", "", ""), ("4", "baja", "", "", "", "", "Kra 10 Num 15-20", "", "", "", "junk", "", "ZZ99")], ", ".join(f"`{n}` string" for n in names))
    got = {r["consecutivo_edan"]: r for r in loaders.load_sites(raw).collect()}
    assert got.keys() == {"1", "4"} and got["1"]["barrio_vereda"] == "El Lido" and got["1"]["coords"] == "3.491092, -76.519175" and got["4"]["coords"] == "junk" and got["4"]["sitio_id"] == "ZZ99" and len(got["1"]["sitio_id"]) == 4
    assert got["1"]["direccion_norm"] == "CL 5 # 43A-15" and got["1"]["integration_handshake"]["handshake"] == "CL5#43A-15" and got["1"]["prioridad"] == "Alta"
    v = spark.createDataFrame([("1/8/2026 10:00:00", "cra 10 # 15-20", "san fernando", "", "https://x/d/" + "a" * 22 + " https://x?id=" + "b" * 22, "x", "9"), ("", "-", "", "", "", "", "")], "`Marca temporal` string, `Dirección completa` string, Barrio string, `Coordenadas Geográficas` string, `Suba los soportes que considere necesarios (Vídeos, fotos, audios, documentos)` string, `Columna 22` string, `Cantidad de casas afectadas` string")
    got = loaders.load_visits(v).collect()
    assert {r["direccion_norm"] for r in got} == {"KR 10 # 15-20, San Fernando, Cali", "-"} and {r["n_evidencias"] for r in got} == {2, 0} and {"n_estructuras_caracterizadas", "visita_id"} <= set(got[0].asDict()) and "Columna 22" not in got[0].asDict()
    times = loaders.visit_times(v.withColumn("visita_id", F.lit("V1"))).collect()
    assert [str(r["ts"]) for r in times] == ["2026-08-01 10:00:00"] and loaders.visit_times(v).count() == 0
    assert loaders.grouped_after(["a", "n_b", "n_x", "c", "n_d"], "n_x") == ["a", "n_b", "n_x", "n_d", "c"]


def test_graph_listing_and_targets(spark):
    nodes = spark.createDataFrame([("t1", "termino", "grieta", None, None), ("p1", "patologia", None, "AIS", "3"), ("t2", "termino", "muro", None, None), ("e1", "elemento", None, None, None)], "id string, tipo string, patron string, doc string, ref string")
    edges = spark.createDataFrame([("t1", "p1", "detecta", None), ("t2", "e1", "detecta", None), ("p1", "x", "indica", 0.4), ("p1", "y", "indica", 0.7), ("e1", "z", "pondera", 1.0)], "de string, a string, relacion string, peso double")
    g = loaders.damage_graph(nodes, edges)
    assert g["severity"].collect() == [("grieta", 0.7)] and sorted(map(tuple, g["terms"].collect())) == [("grieta", "p1", "patologia"), ("muro", "e1", "elemento")] and dict(g["cited"].collect())["p1"] == "AIS 3"
    files = spark.createDataFrame([("f1", "a.jpg", 3.4, -76.5), ("f2", "foto V2.jpg", 3.41, -76.5), ("f3", "b.jpg", None, None), ("f4", "V9_1.jpg", 0.0, 0.0)], "file_id string, name string, lat double, lon double")
    visits = spark.createDataFrame([(0, "V1", "https://x/d/" + "a" * 22), (1, "V2", "https://x/d/" + "a" * 22 + " id=" + "b" * 22)], "pos long, visita_id string, evidencia_soporte string")
    links = loaders.file_visits(visits)
    assert sorted(map(tuple, links.collect())) == [("a" * 22, "V1"), ("b" * 22, "V2")]
    short = spark.createDataFrame([("f1", "V1"), ("f3", "V1"), ("f9", "V1")], "file_id string, visita_id string")
    assert sorted(r["visita_id"] for r in loaders.photos_of(files, short, visits).collect()) == ["V1", "V2"]
    assert [r["file_id"] for r in loaders.stragglers(short, files).collect()] == ["f9"]
    a = spark.createDataFrame([("", "CL 5 # 4-3"), ("3.400000, -76.500000", "KR 1 # 1-1"), (None, "corto"), ("x", "cl 5  # 4-3")], "coords string, direccion_norm string")
    targets = loaders.geocode_targets(a, a)
    assert [r["key"] for r in targets.collect()] == ["CL 5 # 4-3"]
    one = loaders.geocode_accounts(targets, targets.select("key").limit(0), loaders.geocode_pending(targets, targets.select("key").limit(0), 1).select("key", F.lit("").alias("motivo"))).head()
    assert (one["intentadas"], one["cache_hits"], one["llamadas_api"], one["omitidas_por_limite"]) == (1, 0, 1, 0)


def test_parcels_and_bridge(spark, tmp_path):
    import json

    ring = lambda x, y: [[[x - 2e-4, y - 2e-4], [x + 2e-4, y - 2e-4], [x + 2e-4, y + 2e-4], [x - 2e-4, y + 2e-4], [x - 2e-4, y - 2e-4]]]
    one = {"type": "Feature", "properties": {"objectid": 5, "npn": "N1"}, "geometry": {"type": "Polygon", "coordinates": ring(-76.52, 3.44)}}
    two = {"type": "Feature", "properties": {"Predio": " ", "FID": "F7"}, "geometry": {"type": "MultiPolygon", "coordinates": [ring(-76.5, 3.4)]}}
    (tmp_path / "a.geojson").write_text(json.dumps({"features": [{"type": "Feature", "properties": {}, "geometry": {"type": "Point", "coordinates": [0, 0]}}]}))
    (tmp_path / "b.geojson").write_text(json.dumps({"features": [one, two]}))
    found = readers.first_with_rows(spark, [str(tmp_path / "a.geojson"), str(tmp_path / "b.geojson")])
    assert sorted(r["id"] for r in found.collect()) == ["F7", "N1"]
    side = lambda key, lat: spark.createDataFrame([(key, 0, "KR 1 # 1-9, Cali" if key[0] == "V" else "KR 1 # 1-40, Cali", "El Lido", lat, -76.52)], f"{'visita_id' if key[0] == 'V' else 'sitio_id'} string, pos long, direccion_norm string, barrio string, lat double, lon double").withColumns({"coords_fuente": F.lit(""), "consecutivo": F.lit("")})
    v, e = linkage.prepare(side("V1", 3.44)), linkage.prepare(side("S1", 3.44027))  # 30 m apart
    from siteweave.operators.geo import containing, covered

    parcel = lambda d, key: containing(d.select(key, "lat", "lon"), found, key, covered).select(key, F.col("id").alias("parcel"))
    assert linkage.spatial_bridge(v, e).count() == 0  # beyond the circle of the surrogate
    wide = found.withColumn("rings", F.transform("rings", lambda r: F.transform(r, lambda p: F.struct(p["x"].alias("x"), (F.lit(3.44) + (p["y"] - 3.44) * 5).alias("y")))))
    inside = lambda d, key: containing(d.select(key, "lat", "lon"), wide, key, covered).select(key, F.col("id").alias("parcel"))
    assert parcel(v, "visita_id").count() == 1 and [r["sitio_id"] for r in linkage.spatial_bridge(v, e, parcels=(inside(v, "visita_id"), inside(e, "sitio_id"))).collect()] == ["S1"]


def test_chunks_padding_and_order(spark):
    df = spark.createDataFrame([(k, "x" * n) for k, n in enumerate([5, 5, 20, 1, 1, 1, 30, 2])], "k int, t string")
    got = [(r["k"], r["chunk"]) for r in sinks.chunks(df, "k", 20).orderBy("k").collect()]
    want, at, used = [], 0, 0
    for k, n in enumerate([5, 5, 20, 1, 1, 1, 30, 2]):
        size = n + 1 + 2
        if used and used + size > 20:
            at, used = at + 1, 0
        used += size
        want.append((k, at))
    assert got == want and sinks.chunks(df.limit(0), "k").count() == 0
    rng = __import__("random").Random(8)
    for most, per_task, widest in ((100, 2, 20), (100, 1, 400), (60, 3, 1)):
        texts = [(k, "x" * rng.randrange(widest)) for k in range(400)] + [(None, "first")]
        cut = spark.createDataFrame(texts, "k int, t string").repartition(5)
        got = sorted(((-1 if r["k"] is None else r["k"], r["chunk"]) for r in sinks.chunks(cut, "k", most, per_task).collect()))
        want, at, used = [], 0, 0
        for k, t in sorted(((-1 if k is None else k), t) for k, t in texts):
            size = len(t) + len("" if k < 0 else str(k)) + 2
            if used and used + size > most:
                at, used = at + 1, 0
            used += size
            want.append((k, at))
        assert got == want
    pad = sinks.padded(df, "k", 12, 2).orderBy("_row").collect()
    assert len(pad) == 12 and pad[0]["t"] == "x" * 5 and pad[11]["t"] == pad[11]["_blank1"] == ""
    ranked = order.numbered(spark.range(1000).select((F.col("id") % 10).alias("a"), "id"), [-F.col("a"), F.col("id")], "n").orderBy("n").collect()
    assert [r["n"] for r in ranked] == list(range(1, 1001)) and ranked[0]["id"] == 9 and order.numbered(spark.range(0), [F.col("id")], "n").count() == 0
    empty = triage.min_max(spark.createDataFrame([(1.0,), (None,), (1.0,)], "x double"), "x", "y").collect()
    assert {r["y"] for r in empty} == {0.0}


def test_exports(spark, tmp_path):
    m = spark.createDataFrame([("V1", "S1", "geo", 3.0, 0.8), ("V2", None, None, None, None)], "visita_id string, sitio_id string, match_method string, match_score double, trust double")
    records = spark.createDataFrame([("R1", "edan+visita", 0.8, 3.4), ("R2", "solo_visita", 0.3, None)], "registro_id string, fuente string, trust_score double, lat double")
    stats = {(r["seccion"], r["metrica"]): r["valor"] for r in exports.statistics(m, records, {"version": "2", "git": None}).collect()}
    assert stats["umbrales", "trust_base.geo"] == "0.78" and stats["ejecucion", "git"] == "" and stats["trust_por_metodo", "geo.n"] == "1.0" and stats["integracion", "por_fuente.solo_visita"] == "1.0" and stats["matching", "matches"] == "1.0"
    parts = exports.sheets(records, records.limit(1), m, spark.createDataFrame([("a", "b", 1.0)], "seccion string, metrica string, valor double"))
    exports.write_sheets(parts, str(tmp_path / "sheets"))
    assert spark.read.option("header", True).csv(str(tmp_path / "sheets" / "matches")).count() == 1
    band = exports.review_sheets(m, m, m)["revisar"]
    assert band.columns[-3:] == list(exports.REVIEW)
    zones = spark.createDataFrame([(0, "Z1", [[(0.0, 0.0), (1.0, 0.0), (1.0, 1.0)]])], "pos long, zona_id string, rings array<array<struct<x:double,y:double>>>")
    assert exports.geojson_features(zones).head()["feature"] == '{"type":"Feature","properties":{"zona_id":"Z1"},"geometry":{"type":"Polygon","coordinates":[[[0.0,0.0],[1.0,0.0],[1.0,1.0],[0.0,0.0]]]}}'


def test_earlier_generations(spark):
    from siteweave.functions.similarity import token_sort

    e = linkage.prepare(spark.createDataFrame([(0, "S0", "CL 5 # 43A-15 EL LIDO"), (1, "S1", "KR 10 # 15-20 SAN FERNANDO"), (2, "S2", "EDIFICIO LOS PINOS")], "pos long, sitio_id string, direccion_norm string").withColumns({c: F.lit(None).cast(t) for c, t in (("barrio", "string"), ("lat", "double"), ("lon", "double"), ("coords_fuente", "string"), ("consecutivo", "string"))}))
    texts = ["CL 5 # 43A-15", "EL LIDO CL 5 # 43A-15", "EDIFICIO LOS PINO", "KR 10 # 15-20 SN FERNANDO", "", "NADA"]
    v = linkage.prepare(spark.createDataFrame([(f"V{k}", t) for k, t in enumerate(texts)], "visita_id string, direccion_norm string").withColumns({c: F.lit(None).cast(t) for c, t in (("barrio", "string"), ("lat", "double"), ("lon", "double"), ("coords_fuente", "string"), ("consecutivo", "string"))}))
    got = {r["visita_id"]: r["sitio_id"] for r in earlier.fuzzy_sorted(v, e).collect()}
    sites = [r["direccion_norm"] for r in e.orderBy("pos").collect()]
    want = {}
    for k, t in enumerate(texts):
        best = max(((token_sort(t, s), -j) for j, s in enumerate(sites)), default=(0, 0))
        if t and best[0] >= 92:
            want[f"V{k}"] = f"S{-best[1]}"
    assert got == want and want
    first = earlier.first_generation(v, e)
    assert {r["visita_id"]: r["match_method"] for r in first.collect()}["V0"] == "handshake" and first.count() == 6
    assert earlier.compared(first, first).where("v1 <> v2").count() == 0
    c = spark.createDataFrame([("V", 1, 0.6), ("V", 0, 0.6), ("W", 0, 0.9)], "visita_id string, pos long, trust double")
    assert [(r["visita_id"], r["pos"]) for r in earlier.review_band(c).collect()] == [("V", 0)]


def test_calibrated_model_and_rates(spark):
    pairs = spark.createDataFrame([(f"V{k % 40}", k, float(k % 2), None if k % 9 == 0 else k % 2 + (k % 7) / 10.0) for k in range(200)], "visita_id string, pos long, label double, f_a double").withColumn("f_b", F.lit(1.0))
    model = calibrated.fit(pairs, ["f_a", "f_b"], trees=5, folds=2)
    scored = model(pairs.drop("label"))
    assert scored.where("f_a > 1.5 and p < 0.5").count() == 0
    rates = calibrated.precision_recall(model.held, F.col("p"), F.col("label"), 0.5).head()
    assert rates["precision"] > 0.8 and rates["recall"] > 0.8 and 0 < rates["f1"] <= 1
    at = lambda x, k: {n: (x[n], x[n]) for n in ("f_a", "f_b")}
    for r in scored.where("f_a is not null").limit(30).collect():
        assert abs(model.limit(at(r, 1), 1)[0] - r["p"]) < 1e-9
    assert abs(model.limit({"f_a": (-9.0, 9.0), "f_b": (1.0, 1.0)}, 2)[1] - scored.agg(F.max("p")).head()[0]) < 1e-9


def test_labels_and_floors(spark):
    base = {"f_lm": 0.9, "f_tfidf": 0.0, "f_fuzzy": 0.0, "f_barrio": 1.0, "f_numbers": 0.0, "f_sign": 0.0, "f_placed": 1.0, "plate": 0.0, "unparsed": False, "p": 0.1, "blocks": ["geo"]}
    cases = [("sign", {"f_sign": 1.0}, ("handshake", 0.75)), ("plate", {"f_numbers": 1.0}, ("vector", 0.75)), ("far plate", {"f_numbers": 1.0, "plate": 4.0}, ("vector_block", 0.72)), ("veto", {"f_sign": 1.0, "f_lm": 0.44}, None),
             ("unparsed", {"unparsed": True}, ("geo", 0.72)), ("weak", {"unparsed": True, "f_lm": 0.81}, None), ("model", {"p": 0.8, "f_lm": None, "f_tfidf": 0.6}, ("tfidf", 0.8)), ("rounded", {"p": 0.696, "f_lm": 0.1, "f_fuzzy": 0.7}, ("fuzzy", 0.7))]
    rows = [{"visita_id": n, "pos": 1, **base, **over} for n, over, _ in cases] + [{"visita_id": "sign", "pos": 0, **base}]
    got = {r["visita_id"]: (r["match_method"], r["trust"]) for r in calibrated.decided(spark.createDataFrame(rows)).collect()}
    assert got == {n: want for n, _, want in cases if want}


@pytest.fixture(scope="module")
def modelled(spark):
    """120 sites and 160 visits in few roads and neighbourhoods, with embeddings and near-certain matches."""
    import random

    rng = random.Random(3)
    unit = lambda s: [rng.gauss(0, s) for _ in range(48)]
    alike = unit(1)
    vecs = [[x + y for x, y in zip(alike, unit(0.2))] if k % 5 == 1 else unit(1) for k in range(120)]
    address = lambda k: f"{('CL', 'KR')[k % 2]} {k % 5 + 1} # {k % 7 + 1}-{k % 90 + 1}"
    sites = [(k, f"S{k}", address(k), ("Granada", "El Lido", "-", "Sur")[k % 4], None if k % 6 == 0 else 3.4 + k * 7 % 50 / 1e4, -76.5 - k * 11 % 50 / 1e4, vecs[k] if k % 10 else None, "exif", "") for k in range(120)]
    kind = lambda j, k: "" if j % 8 == 5 else "EDIFICIO AZUL" if j % 8 == 6 else f"{address(k)} APTO 2" if j % 3 else address(k)
    visits = [(f"V{j}", kind(j, j * 7 % 120), None if j % 9 == 0 else sites[j * 7 % 120][3].lower(), sites[j * 7 % 120][4] if j % 2 else None, sites[j * 7 % 120][5], [x + rng.gauss(0, 0.3) for x in vecs[j * 7 % 120]] if j % 7 else None, "exif", "") for j in range(160)]
    e = linkage.prepare(spark.createDataFrame(sites, "pos long, sitio_id string, direccion_norm string, barrio string, lat double, lon double, emb array<double>, coords_fuente string, consecutivo string"))
    v = linkage.prepare(spark.createDataFrame(visits, "visita_id string, direccion_norm string, barrio string, lat double, lon double, emb array<double>, coords_fuente string, consecutivo string"))
    similar = written(linkage.nearest_embeddings(v, e, 3, addressed=False), "similar")
    known = linkage.cascade(v, e, tiers=("handshake", "vector", "vector_block")).where("sitio_id is not null").join(e.select("sitio_id", "pos"), "sitio_id").select("visita_id", "pos")
    return written(v, "v"), written(e, "e"), similar, written(known, "known")


def test_blocks_counted_without_their_pairs(spark, modelled):
    v, e, similar, _ = modelled
    a, b = v.select("visita_id", "vec", "barrio", "lat", "lon").collect(), e.select("pos", "vec", "barrio", "lat", "lon").collect()
    top = {(r["visita_id"], r["pos"]) for r in similar.collect()}
    near = {(r["visita_id"], r["pos"]) for r in calibrated._near(v, e, 200.0).collect()}
    area = lambda r: (r["barrio"] or "").strip().upper()
    want = {}
    for x in a:
        for y in b:
            key = (x["visita_id"], y["pos"])
            held = [n for n, hit in (("barrio", len(area(x)) > 3 and area(x) == area(y)), ("emb", key in top), ("geo", key in near), ("via", x["vec"]["road"] != 0 and int(x["vec"]["road"]) == int(y["vec"]["road"]))) if hit]
            if held:
                want[key] = held
    assert {(r["visita_id"], r["pos"]): r["blocks"] for r in calibrated.candidates(v, e, 200.0, similar).collect()} == want
    counts = {}
    for held in want.values():
        counts["+".join(held)] = counts.get("+".join(held), 0) + 1
    assert {r["blocks"]: r["n"] for r in calibrated.corroboration(v, e, 200.0, similar).collect()} == counts and len(counts) > 8


def test_close_pairs_are_counted_by_spots(spark, monkeypatch):
    rows = [(k, f"V{k}", "CL 5 # 3-8", ("Granada", "El Lido")[k % 2], 3.4 + k % 3 / 1e4, -76.5, "exif", "") for k in range(600)]
    both = linkage.prepare(spark.createDataFrame(rows, "pos long, visita_id string, direccion_norm string, barrio string, lat double, lon double, coords_fuente string, consecutivo string"))
    met, join = [], calibrated.near_join
    monkeypatch.setattr(calibrated, "near_join", lambda x, y, *a: met.append((x.count(), y.count())) or join(x, y, *a))
    got = {r["blocks"]: r["n"] for r in calibrated.corroboration(both, both).collect()}
    assert got == {"barrio+geo+via": 180_000, "geo+via": 180_000} and met == [(6, 6)]


def test_hot_keys_meet_in_slices(spark):
    left = spark.createDataFrame([(k, "hot" if k % 3 else None if k % 2 else "b") for k in range(90)], "i long, k string")
    right = left.select(F.col("i").alias("j"), "k").where("j < 40")
    want = sorted((x["i"], y["j"]) for x in left.collect() for y in right.collect() if x["k"] and x["k"] == y["k"])
    assert sorted((r["i"], r["j"]) for r in calibrated.split_join(left, right, ["k"], 7).collect()) == want


def test_closed_blocks_hold_no_match(spark, modelled, monkeypatch):
    """The result of opening only what the trees' bound asks for is that of all candidates."""
    v, e, similar, known = modelled
    fit = calibrated.fit
    # Labels by the numbers alone, so that the trees can tell what closed blocks lack.
    monkeypatch.setattr(calibrated, "fit", lambda labelled, *a, **kw: fit(labelled.withColumn("label", F.col("f_numbers")), *a, **kw))
    told, run = {}, lambda **kw: sorted((r["visita_id"], r["pos"], r["trust"], r["match_method"], "+".join(r["blocks"])) for r in calibrated.calibrated(v, e, similar, known, trees=12, folds=2, **kw).collect())
    got = run(stats=told)
    assert got and 0 < told["opened"] < 80
    monkeypatch.setattr(calibrated, "_opened", lambda model, v, *_: v.select("visita_id", F.array(F.lit("road"), F.lit("area")).alias("open")))
    every = {}
    assert run(stats=every) == got and every["rest"] > told["rest"]
    assert every["listed"] + every["rest"] == calibrated.candidates(v, e, 200.0, similar).count()


def test_streams(spark, tmp_path):
    import json

    folder, table = tmp_path / "in", tmp_path / "table"
    folder.mkdir()
    write = lambda name, rows: (folder / name).write_text("\n".join(json.dumps(r) for r in rows))
    run = lambda: state.latest_per_key(state.new_records(spark, str(folder), "k string, ts long, x string"), "k", "ts", str(table), str(tmp_path / "cp")).awaitTermination()
    write("a.json", [{"k": "a", "ts": 1, "x": "old"}, {"k": "b", "ts": 5, "x": "b"}])
    run()
    write("b.json", [{"k": "a", "ts": 2, "x": "new"}, {"k": "b", "ts": 4, "x": "late"}, {"k": "c", "ts": 1, "x": "c"}])
    run()
    assert {r["k"]: r["x"] for r in state.read_latest(spark, str(table)).collect()} == {"a": "new", "b": "b", "c": "c"}
    events = state.new_records(spark, str(folder), "k string, ts long, x string").select(F.timestamp_seconds("ts").alias("t"), "k")
    q = state.windowed_counts(events, "t", "k").writeStream.format("memory").queryName("windows").outputMode("complete").trigger(availableNow=True).start()
    q.awaitTermination()
    assert {r["k"]: r["n"] for r in spark.table("windows").collect()} == {"a": 2, "b": 2, "c": 1}
