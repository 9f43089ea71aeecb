"""Queries for rosters, proposals, cross-match reports, loaders and exports, over inputs derived from the star-schema tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siteweave.functions import text
from siteweave.operators import calibrated, earlier, linkage, proposals, reports, roster
from siteweave.plans.linkage import _ALL, _PRE, _TIER_SQL, both, matched
from siteweave.plans.triage import _HAV, _zones, table
from siteweave.shared import written
from siteweave.sources import exports, loaders, sinks
from siteweave.sources.tables import SITES, VISITS, sites, visits

QUERIES, SQL = {}, {}


def query(sql: str | None = None):
    def keep(f):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return keep


NOW = "2026-08-16 12:00:00"
TERMS = [("thingst", 0.9), ("bleing", 0.25)]


def records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Integrated records: a visit each, with its site's number as origin for every ninth."""
    k = F.col("vpos")
    return visits(spark, sf_dir, spread=True).select(
        F.concat(F.lit("R"), k).alias("registro_id"), F.when(k % 9 == 0, F.concat(F.lit("arcgis:{s"), "true_pos", F.lit("}"))).otherwise(F.concat(F.lit("app:"), k)).alias("sitio_id"), "visita_id",
        F.coalesce("direccion_norm", F.lit("")).alias("direccion_unificada"), F.coalesce("barrio", F.lit("")).alias("barrio_unificado"), (k % 22).cast("string").alias("comuna_unificada"),
        F.when(F.col("lat").isNotNull(), F.format_string("%.6f, %.6f", "lat", "lon")).otherwise("").alias("coords_unificadas"), F.when(k % 3 == 0, "Riesgo ALTO").when(k % 3 == 1, "medio").otherwise("").alias("nivel_riesgo"), F.lit("").alias("estado_estructura"), F.lit("").alias("nombre_estructura"),
        F.when(k % 5 == 0, "thingst").when(k % 5 == 1, "BLEING x").otherwise("").alias("descripcion_visita"), F.when(k % 7 == 0, "Sí").otherwise("no").alias("requiere_demolicion"), (k % 2).cast("string").alias("n_fallecidos_total"), (k % 3).cast("string").alias("n_atrapamientos_total"),
        F.when(k % 4 == 3, "").otherwise((k % 4).cast("string")).alias("n_rescatados_total"), F.when(k % 6 == 0, "").otherwise((F.lit(1786000000000) + (k * 3571) % 900000000).cast("string")).alias("evaluacion_creado_utc"), F.lit("").alias("tipo_estructura_edan"), F.lit("casa").alias("tipo_estructura_visita"),
    )


def inspections(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sites(spark, sf_dir).select(F.lower("sitio_id").alias("gid"), F.col("lat").alias("rlat"), F.col("lon").alias("rlon"), F.lit("2026-08-10").alias("fecha"))


def rostered(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = records(spark, sf_dir)
    done = r.where(F.substring("registro_id", 2, 20).cast("long") % 5 == 0).select("registro_id")
    times = spark.createDataFrame([], "visita_id string, ts timestamp")
    zones = _zones(spark).select("pos", "zona_id", (F.col("pos") % 3).cast("string").alias("ola"), F.concat(F.lit("D"), F.col("pos") % 4).alias("despacho"), "rings")
    return roster.assignments(r, done, times, NOW, spark.createDataFrame(TERMS, "pattern string, weight double"), zones, inspections(spark, sf_dir))


#: The roster by arithmetic on the keys: coordinates as the six decimals of their text.
_ROSTER = f"""v AS (SELECT *, vpos AS k, round(lat, 6) AS la, round(lon, 6) AS lo FROM ({VISITS}) WHERE lat IS NOT NULL),
 z AS (SELECT i AS pos, concat('Z', i) AS zona_id, CAST(i % 3 AS VARCHAR) AS ola, concat('D', i % 4) AS despacho, -76.535003::DOUBLE + (i % 5) * 0.01::DOUBLE AS cx, 3.435003::DOUBLE + floor(i / 5) * 0.01::DOUBLE AS cy FROM range(25) t(i)),
 vz AS (SELECT k, z.zona_id, ola, despacho FROM v JOIN z ON abs(lo - cx) < 0.004 AND abs(la - cy) < 0.004 AND NOT (z.pos % 2 = 0 AND abs(lo - cx) < 0.001 AND abs(la - cy) < 0.001)),
 s AS ({SITES}), x AS (SELECT k, lower(s.sitio_id) AS gid FROM v JOIN s ON v.k % 9 = 0 AND s.pos = v.true_pos),
 n AS (SELECT k, lower(s.sitio_id) AS gid, {_HAV.format(a='v.la', b='v.lo', c='s.lat', d='s.lon')} AS d FROM v JOIN s ON abs(v.la - s.lat) < 0.0005 AND abs(v.lo - s.lon) < 0.0005),
 n1 AS (SELECT * FROM n WHERE d <= 40 QUALIFY row_number() OVER (PARTITION BY k ORDER BY d, gid) = 1),
 a AS (SELECT v.k, k % 5 = 0 AS visited, coalesce(vz.zona_id, '') AS zona_id, coalesce(ola, '') AS ola, coalesce(despacho, '') AS despacho, CASE WHEN k % 5 = 0 THEN 0.9::DOUBLE WHEN k % 5 = 1 THEN 0.25::DOUBLE ELSE 0.0::DOUBLE END AS sev,
  CASE WHEN k % 6 <> 0 THEN (epoch_us(TIMESTAMP '{NOW}') - (epoch_us(TIMESTAMP '1970-01-01') + (1786000000000 + (k * 3571) % 900000000 - 18000000) * 1000)) / 86400e6 END AS age, 3 * (k % 2) + 2 * (k % 3) + CASE WHEN k % 4 = 3 THEN 0 ELSE k % 4 END AS w,
  x.gid AS xg, n1.gid AS ng, n1.d AS nd FROM v LEFT JOIN vz USING (k) LEFT JOIN x USING (k) LEFT JOIN n1 USING (k)),
 m AS (SELECT *, min(age) FILTER (WHERE NOT visited) OVER () AS lo, max(age) FILTER (WHERE NOT visited) OVER () AS hi FROM a),
 p AS (SELECT *, round(30 * sev + 25 * CASE WHEN w > 0 THEN 1 - pow(0.6::DOUBLE, w) ELSE 0.0::DOUBLE END + 20 * coalesce((age - lo) / nullif(hi - lo, 0), 0) + 10 * CASE k % 3 WHEN 0 THEN 1.0::DOUBLE WHEN 1 THEN 0.6::DOUBLE ELSE 0.0::DOUBLE END + 10 * CASE WHEN k % 7 = 0 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END + 5 * CASE ola WHEN '1' THEN 1.0::DOUBLE WHEN '2' THEN 0.5::DOUBLE ELSE 0.0::DOUBLE END, 1) AS score FROM m),
 r AS (SELECT concat('R', k) AS registro_id, *, CASE WHEN NOT visited THEN CAST(row_number() OVER (PARTITION BY visited ORDER BY score DESC, coalesce(age, -1) DESC, concat('R', k)) AS INT) END AS prioridad FROM p)"""


@query(f"""WITH {_ROSTER} SELECT registro_id, coalesce(prioridad, 0) AS prioridad, CASE WHEN visited THEN 'visitado' ELSE 'pendiente' END AS estado_visita, score, zona_id, ola, despacho, round(sev, 2) AS grafo_severidad, coalesce(round(age, 1), -1) AS antiguedad_dias,
 concat(CASE WHEN zona_id = '' THEN 'fuera_de_zona' ELSE '' END, CASE WHEN zona_id = '' AND age IS NULL THEN ',' ELSE '' END, CASE WHEN age IS NULL THEN 'sin_timestamp' ELSE '' END) AS flags, xg IS NOT NULL OR ng IS NOT NULL AS ede_hecha, CASE WHEN xg IS NOT NULL THEN 'globalid' WHEN ng IS NOT NULL THEN 'cercania' ELSE '' END AS ede_match, coalesce(CASE WHEN xg IS NULL THEN CAST(round(nd) AS BIGINT) END, -1) AS ede_dist_m FROM r""")
def assignment_roster(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = rostered(spark, sf_dir).na.fill(0, ["prioridad"]).na.fill(-1.0, ["antiguedad_dias"]).na.fill(-1, ["ede_dist_m"]).na.fill("", ["ede_match"])
    return out.select("registro_id", "prioridad", "estado_visita", "score", "zona_id", "ola", "despacho", "grafo_severidad", "antiguedad_dias", "flags", "ede_hecha", "ede_match", "ede_dist_m")


@query(f"""WITH {_ROSTER} SELECT count(*) AS filas, count(*) FILTER (WHERE NOT visited) AS pendientes, count(*) FILTER (WHERE visited) AS visitados, count(*) FILTER (WHERE sev > 0) AS con_grafo, count(*) FILTER (WHERE w > 0) AS con_victimas, count(*) FILTER (WHERE xg IS NOT NULL OR ng IS NOT NULL) AS ede_hechas,
 count(*) FILTER (WHERE xg IS NULL AND ng IS NULL) AS ede_pendientes, max(score) FILTER (WHERE NOT visited) AS score_max, min(score) FILTER (WHERE NOT visited) AS score_min FROM r""")
def roster_counters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return roster.counters(rostered(spark, sf_dir))


def forms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Inspection forms with every answer, by the number of the order."""
    k = F.col("o_orderkey")
    return table(spark, sf_dir, "orders").select(
        F.concat(F.lit("E"), k).alias("id_edan"), F.when(k % 17 == 0, "SI ").otherwise("no").alias("colapso_total"), F.when(k % 4 == 0, "h").when(k % 4 == 1, "I3").otherwise("i2").alias("criterio_habitabilidad"), F.when(k % 3 != 0, "si").otherwise("nan").alias("colapso_parcial"),
        F.when(k % 5 < 3, "severo").when(k % 5 == 3, "moderado").alias("danos_estructura"), F.when(k % 7 < 3, "alto").when(k % 7 < 5, "medio_alto").otherwise("bajo").alias("severidad_danos"), F.when(k % 6 == 0, "medio").alias("severidad_danos_calc"), F.when(k % 2 == 0, "si").alias("inclinacion_importante"),
        F.when(k % 11 < 6, "si").alias("asentamiento_severo"), F.when(k % 13 < 5, "severo").when(k % 13 < 9, "moderado").alias("danos_contrapiso_entrepiso_muroscont"), F.when(k % 19 < 9, "malo").alias("estado_edificacion"), F.when(k % 10 == 0, "evacuar, demoler").otherwise("monitoreo").alias("recomendaciones"),
        F.when(k % 8 == 1, "Grieta en muro. Se pide demoler").when(k % 8 == 3, "no se requiere por ahora demoler; sin grieta").otherwise("").alias("eval_estructural"),
    )


FORM_TERMS = [("grietas?", "grieta_generica", "patologia"), ("muro", "muro_carga", "elemento"), ("demoler", "demoler", "accion")]
_K = "o_orderkey"
_FORMS = f"""f AS (SELECT {_K} AS k, concat('E', {_K}) AS id_edan, {_K} % 17 = 0 AS total, CASE WHEN {_K} % 4 = 0 THEN 'h' WHEN {_K} % 4 = 1 THEN 'i3' ELSE 'i2' END AS hab, {_K} % 8 = 1 AS told, {_K} % 10 = 0 AS asked,
 CAST(CASE WHEN {_K} % 3 <> 0 THEN 25 ELSE 0 END + CASE WHEN {_K} % 5 < 3 THEN 20 WHEN {_K} % 5 = 3 THEN 10 ELSE 0 END + 15 * greatest(CASE WHEN {_K} % 7 < 3 THEN 1.0::DOUBLE WHEN {_K} % 7 < 5 THEN 0.6::DOUBLE ELSE 0.1::DOUBLE END, CASE WHEN {_K} % 6 = 0 THEN 0.3::DOUBLE ELSE 0.0::DOUBLE END) + CASE WHEN {_K} % 2 = 0 THEN 12 ELSE 0 END + CASE WHEN {_K} % 11 < 6 THEN 10 ELSE 0 END
 + CASE WHEN {_K} % 13 < 5 THEN 8 WHEN {_K} % 13 < 9 THEN 4 ELSE 0 END + CASE WHEN {_K} % 19 < 9 THEN 5 ELSE 0 END + CASE WHEN {_K} % 4 = 1 THEN 5 ELSE 0 END AS DOUBLE) AS points FROM orders),
 g AS (SELECT *, CASE WHEN total THEN 100.0::DOUBLE ELSE round_even(points, 0) END AS base, CASE WHEN total THEN 100 ELSE CAST(least(100.0::DOUBLE, round_even(points + CASE WHEN asked THEN 20 ELSE 0 END + CASE WHEN told THEN 10 + 15 * round(0.25::DOUBLE * 0.8::DOUBLE, 3) ELSE 0 END, 0)) AS INT) END AS score, asked OR told AS mention FROM f WHERE total OR hab IN ('i2', 'i3')),
 c AS (SELECT *, CASE WHEN total THEN 'demolicion_inmediata' WHEN mention AND base >= 50 THEN 'demolicion_prioritaria' WHEN NOT mention AND base >= 70 THEN 'demolicion_probable' END AS categoria FROM g)"""


def proposed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return proposals.proposals(forms(spark, sf_dir), FORM_TERMS, {"grieta_generica": 0.25}, {"muro_carga": 0.8}, {}, {"grieta_generica": "AIS-manual 1"}, NOW)


@query(f"WITH {_FORMS} SELECT CAST(row_number() OVER (ORDER BY score DESC, id_edan) AS INT) AS prioridad, id_edan, categoria, score, CASE WHEN told THEN 'grieta_generica@muro_carga [AIS-manual 1]' ELSE '' END AS hallazgos_texto FROM c WHERE categoria IS NOT NULL")
def demolition_proposals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return proposed(spark, sf_dir).select("prioridad", "id_edan", "categoria", "score", "hallazgos_texto")


@query(f"WITH {_FORMS} SELECT categoria, count(*) AS n FROM c WHERE categoria IS NOT NULL GROUP BY categoria")
def demolition_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return proposals.by_class(proposed(spark, sf_dir))


def managed(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, ...]:
    """The field manager's tables: zones of one polygon, inspections without addresses, points and today's dispatches."""
    ring = F.transform(F.col("rings")[0], lambda p: F.array(p["y"], p["x"]))
    zones = _zones(spark).where("pos % 5 <> 4").select("pos", "zona_id", F.concat(F.lit("Comuna "), "pos").alias("comuna"), F.lit("L").alias("lider"), F.lit("ACTIVA").alias("estado"), (F.col("pos") * 2).cast("string").alias("n_puntos"), F.to_json(ring).alias("poligono"))
    s = sites(spark, sf_dir)
    evaluations = s.where("pos % 2 = 0").select("pos", "sitio_id", F.concat(F.lit("G"), "pos").alias("global_id"), F.lit("2026-08-10").alias("fecha"), F.lit("alto").alias("severidad"), F.lit("i2").alias("habitabilidad"), F.col("lat").alias("rlat"), F.col("lon").alias("rlon"), F.lit("").alias("direccion"))
    points = s.where("pos % 3 = 0").select("pos", F.concat(F.lit("Z"), F.col("pos") % 25).alias("zona_id"), F.when(F.col("pos") % 2 == 0, "pendiente").otherwise("CERRADO").alias("estado"), F.col("lat").alias("rlat"), F.col("lon").alias("rlon"))
    dispatches = spark.range(3).select(F.concat(F.lit("Z"), "id").alias("zona_id"))
    asked = visits(spark, sf_dir).select(F.col("visita_id").alias("registro_id"), "lat", "lon", F.col("direccion_norm").alias("direccion"), F.when(F.col("vpos") % 4 == 0, "Z1").when(F.col("vpos") % 4 == 1, "Z99").alias("zona_id"))
    return asked, zones, evaluations.drop("sitio_id"), points, dispatches


_NEAREST = "(SELECT v.visita_id, s.pos, {h} AS d FROM v JOIN s ON {w} AND abs(v.lat - s.lat) < 0.0005 AND abs(v.lon - s.lon) < 0.0005 WHERE {h} <= 40 QUALIFY row_number() OVER (PARTITION BY v.visita_id ORDER BY {h}, s.pos) = 1)"
_H = _HAV.format(a="v.lat", b="v.lon", c="s.lat", d="s.lon")
_MANAGED = f"""v AS ({VISITS}), s AS ({SITES}), z AS (SELECT i AS pos, concat('Z', i) AS zona_id, -76.535003::DOUBLE + (i % 5) * 0.01::DOUBLE AS cx, 3.435003::DOUBLE + floor(i / 5) * 0.01::DOUBLE AS cy FROM range(25) t(i) WHERE i % 5 <> 4),
 i AS (SELECT visita_id, z.zona_id FROM v JOIN z ON abs(v.lon - cx) < 0.004 AND abs(v.lat - cy) < 0.004), f AS {_NEAREST.format(h=_H, w='s.pos % 2 = 0')}, p AS {_NEAREST.format(h=_H, w='s.pos % 3 = 0')},
 m AS (SELECT v.visita_id AS registro_id, coalesce(i.zona_id, CASE WHEN v.vpos % 4 = 0 THEN 'Z1' WHEN v.vpos % 4 = 1 THEN 'Z99' END) AS zona_id, CASE WHEN i.zona_id IS NOT NULL THEN 'poligono' WHEN v.vpos % 4 < 2 THEN 'roster' END AS zona_via, f.pos IS NOT NULL AS f3_hecha, concat('G', f.pos) AS gid, round(f.d, 1) AS f3_dist_m, CASE WHEN p.pos IS NOT NULL THEN CASE WHEN p.pos % 2 = 0 THEN 'pendiente' ELSE 'CERRADO' END END AS punto_estado
  FROM v LEFT JOIN i USING (visita_id) LEFT JOIN f USING (visita_id) LEFT JOIN p USING (visita_id))"""


@query(f"WITH {_MANAGED} SELECT registro_id, coalesce(zona_id, '') AS zona_id, coalesce(zona_via, '') AS zona_via, f3_hecha, CASE WHEN f3_hecha THEN gid ELSE '' END AS f3_global_id, coalesce(f3_dist_m, -1) AS f3_dist_m, coalesce(punto_estado, '') AS punto_estado FROM m")
def manager_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    asked, zones, evaluations, points, _ = managed(spark, sf_dir)
    out = reports.manager_cross(asked, zones, evaluations, points).na.fill("", ["zona_id", "zona_via", "f3_global_id", "punto_estado"]).na.fill(-1.0, ["f3_dist_m"])
    return out.select("registro_id", "zona_id", "zona_via", "f3_hecha", "f3_global_id", "f3_dist_m", "punto_estado")


@query(f"""WITH {_MANAGED}, c AS (SELECT CASE WHEN zona_id IN (SELECT zona_id FROM z) THEN zona_id ELSE '(fuera de zona)' END AS zona_id, count(*) AS n, count(*) FILTER (WHERE f3_hecha) AS h FROM m GROUP BY 1),
 e AS (SELECT zona_id, concat('Comuna ', pos) AS comuna, CAST(2 * pos AS INT) AS np FROM z UNION ALL SELECT zona_id, '', 0 FROM c WHERE zona_id = '(fuera de zona)'), w AS (SELECT concat('Z', pos % 25) AS zona_id, count(*) AS k FROM s WHERE pos % 6 = 0 GROUP BY 1)
SELECT e.zona_id, comuna, e.zona_id IN ('Z0', 'Z1', 'Z2') AS despacho_hoy, coalesce(n, 0) AS n_criticos, coalesce(h, 0) AS n_f3_hechas, coalesce(n, 0) - coalesce(h, 0) AS n_faltantes, np AS gestor_n_puntos, coalesce(w.k, 0) AS gestor_pendientes FROM e LEFT JOIN c USING (zona_id) LEFT JOIN w ON w.zona_id = e.zona_id""")
def manager_zones(spark: SparkSession, sf_dir: str) -> DataFrame:
    asked, zones, evaluations, points, dispatches = managed(spark, sf_dir)
    return reports.manager_rollup(zones, reports.manager_cross(asked, zones, evaluations, points), dispatches, points).drop("lider", "estado_zona")


@query(f"WITH {_MANAGED} SELECT count(*) AS total_criticos, count(*) FILTER (WHERE f3_hecha) AS f3_hechas, CAST(0 AS BIGINT) AS f3_por_direccion, CAST(0 AS BIGINT) AS f3_por_combinado, count(*) FILTER (WHERE zona_via = 'poligono') AS zona_por_poligono, count(*) FILTER (WHERE NOT f3_hecha) AS f3_faltantes, (SELECT count(*) FROM s WHERE pos % 3 = 0) AS gestor_puntos_totales, (SELECT count(*) FROM s WHERE pos % 6 = 0) AS gestor_puntos_pendientes, CAST(3 AS BIGINT) AS zonas_con_despacho_hoy FROM m")
def manager_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    asked, zones, evaluations, points, dispatches = managed(spark, sf_dir)
    return reports.manager_summary(reports.manager_cross(asked, zones, evaluations, points), points, dispatches)


def surveyed(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Critical records and surveys whose addresses agree in full or not at all."""
    s = sites(spark, sf_dir)
    survey = s.where("lat is not null").select("pos", F.lower("sitio_id").alias("gid"), F.col("lat").alias("rlat"), F.col("lon").alias("rlon"), F.lit("").alias("rkey"), F.lit("2026-08-11").alias("fecha"), F.lit("ana").alias("evaluador"))
    return records(spark, sf_dir), survey


_SURVEY = f"""v AS (SELECT *, vpos AS k, round(lat, 6) AS la, round(lon, 6) AS lo FROM ({VISITS})), s AS (SELECT *, lower(sitio_id) AS gid FROM ({SITES}) WHERE lat IS NOT NULL), x AS (SELECT k, s.gid FROM v JOIN s ON v.k % 9 = 0 AND s.pos = v.true_pos),
 n AS (SELECT k, s.gid, {_HAV.format(a='v.la', b='v.lo', c='s.lat', d='s.lon')} AS d FROM v JOIN s ON abs(v.la - s.lat) < 0.0005 AND abs(v.lo - s.lon) < 0.0005), n1 AS (SELECT * FROM n WHERE d <= 20 QUALIFY row_number() OVER (PARTITION BY k ORDER BY d, gid) = 1),
 m AS (SELECT concat('R', k) AS registro_id, coalesce(x.gid, n1.gid) AS survey_globalid, CASE WHEN x.gid IS NOT NULL THEN 'globalid' WHEN n1.gid IS NOT NULL THEN 'cercania' END AS match, CASE WHEN x.gid IS NULL THEN CAST(round(n1.d) AS BIGINT) END AS dist_m FROM v LEFT JOIN x USING (k) LEFT JOIN n1 USING (k))"""


@query(f"WITH {_SURVEY} SELECT registro_id, coalesce(survey_globalid, '') AS survey_globalid, coalesce(match, '') AS match, coalesce(dist_m, -1) AS dist_m, CASE WHEN match IS NULL THEN 'pendiente' ELSE 'levantado' END AS estado FROM m")
def survey_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = reports.survey_cross(*surveyed(spark, sf_dir)).na.fill("", ["survey_globalid", "match"]).na.fill(-1, ["dist_m"])
    return out.select("registro_id", "survey_globalid", "match", "dist_m", F.col("estado_cruce").alias("estado"))


@query(f"WITH {_SURVEY} SELECT '(fuera de zona)' AS zona_id, count(*) AS n_criticos, count(match) AS n_levantados, count(*) - count(match) AS n_pendientes FROM m")
def survey_zones(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.survey_rollup(reports.survey_cross(*surveyed(spark, sf_dir)))


@query(f"WITH {_SURVEY} SELECT count(*) AS total_criticos, count(match) AS levantados, count(*) - count(match) AS pendientes, count(*) FILTER (WHERE match = 'globalid') AS por_globalid, count(*) FILTER (WHERE match = 'cercania') AS por_cercania, CAST(0 AS BIGINT) AS por_direccion, CAST(0 AS BIGINT) AS por_combinado, count(DISTINCT survey_globalid) AS survey_usados, (SELECT count(*) FROM s) AS survey_puntos FROM m")
def survey_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    critical, survey = surveyed(spark, sf_dir)
    return reports.survey_summary(reports.survey_cross(critical, survey), survey)


@query()
def inspection_cascade(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records of sites against inspections of visits, through the tiers that need no embedding."""
    s, v = sites(spark, sf_dir), visits(spark, sf_dir)
    place = lambda d: F.when(F.col("lat").isNotNull(), F.format_string("%.6f, %.6f", "lat", "lon")).otherwise("")
    r = s.select("pos", F.col("sitio_id").alias("registro_id"), "sitio_id", F.lit("").alias("visita_id"), F.col("direccion_norm").alias("direccion_unificada"), F.col("barrio").alias("barrio_unificado"), F.lit("").alias("comuna_unificada"), place(s).alias("coords_unificadas"), F.lit("").alias("tipo_estructura_edan"), F.lit("casa").alias("tipo_estructura_visita"))
    f = v.select(F.col("visita_id").alias("id_edan"), "direccion_norm", F.col("barrio").alias("barrio_vereda"), F.lit("").alias("comuna"), place(v).alias("coords"), F.lit("casa").alias("uso_edificacion"))
    return reports.inspection_cascade(r, f, lambda a, b: linkage.cascade(a, b), linkage.prepare)


@query("""WITH c AS (SELECT CAST(user_id AS VARCHAR) AS registro_id, event_id, epoch_us(ts) // 1000 AS ms, event_type FROM events)
SELECT registro_id, CAST(event_id AS VARCHAR) AS visita_id, event_type AS estado, CASE WHEN event_type = 'click' THEN 'si' ELSE '' END AS requiere_demolicion, CAST(ms AS VARCHAR) AS evaluacion_creado_utc, CASE WHEN event_id % 2 = 0 THEN 'E' ELSE 'I' END AS tipo_estructura_visita FROM c QUALIFY row_number() OVER (PARTITION BY registro_id ORDER BY ms DESC, event_id) = 1""")
def flat_cases(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("event_id")
    nested = table(spark, sf_dir, "events").select(
        k.alias("pos"), F.col("user_id").cast("string").alias("id"), F.lit("x").alias("estado"), F.col("event_type").alias("estadoEtiqueta"), F.lit("").alias("direccion"), F.lit(3.4).alias("lat"), F.lit(None).cast("double").alias("lng"), F.lit("p").alias("placeId"), F.lit("7").alias("comuna"), F.lit("").alias("comunaEtiqueta"), F.lit(None).cast("string").alias("barrio"), F.lit("u").alias("resumenUnidad"),
        F.struct(F.lit("t").alias("tipoInmuebleEtiqueta"), F.lit("d").alias("descripcion")).alias("ingreso"), F.struct(F.lit("I").alias("tipoInmuebleEtiqueta"), F.lit("").alias("nombreEdificio")).alias("inmueble"),
        F.struct(k.cast("string").alias("id"), F.unix_millis(F.col("ts").cast("timestamp")).alias("creado_utc"), F.when(F.col("event_type") == "click", "A").alias("tipoColapso"), F.lit("x").alias("tipoColapsoEtiqueta"), F.when(k % 2 == 0, "E").alias("tipoInmuebleEtiqueta"), F.lit("h").alias("habitabilidadEtiqueta"), F.lit("c").alias("conceptoTecnico"), F.struct(*(F.lit("1").alias(n) for n in ("fallecidos", "atrapados", "rescatados"))).alias("victimas")).alias("evaluacion"),
    )
    return loaders.flat_cases(nested).select("registro_id", "visita_id", "estado", "requiere_demolicion", "evaluacion_creado_utc", "tipo_estructura_visita")


@query(f"WITH v AS ({VISITS}) SELECT upper(trim(direccion_norm)) AS key, min(trim(direccion_norm)) AS direccion FROM v WHERE lat IS NULL AND length(trim(direccion_norm)) >= 7 GROUP BY 1")
def geocode_targets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return loaders.geocode_targets(located_text(visits(spark, sf_dir)))


def located_text(df: DataFrame) -> DataFrame:
    return df.withColumn("coords", F.when(F.col("lat").isNotNull(), F.format_string("%.6f, %.6f", "lat", "lon")).otherwise(""))


@query(f"WITH t AS (SELECT DISTINCT upper(trim(direccion_norm)) AS key FROM ({VISITS}) WHERE lat IS NULL AND length(trim(direccion_norm)) >= 7), c AS (SELECT DISTINCT upper(trim(direccion_norm)) AS key FROM ({SITES}) WHERE lat IS NULL) SELECT count(*) AS intentadas, count(c.key) AS cache_hits, count(*) - count(c.key) AS llamadas_api, count(*) - count(c.key) AS aceptadas_nuevas, CAST(0 AS BIGINT) AS rechazadas_nuevas, CAST(0 AS BIGINT) AS omitidas_por_limite FROM t LEFT JOIN c USING (key)")
def geocode_accounts(spark: SparkSession, sf_dir: str) -> DataFrame:
    targets = loaders.geocode_targets(located_text(visits(spark, sf_dir)))
    cache = sites(spark, sf_dir).where("lat is null").select(text.cache_key(F.col("direccion_norm")).alias("key")).distinct()
    return loaders.geocode_accounts(targets, cache, loaders.geocode_pending(targets, cache).select("key", F.lit("").alias("motivo")))


@query(f"WITH e AS (SELECT consecutivo FROM ({SITES}) WHERE regexp_full_match(consecutivo, '[1-9][0-9]{{0,4}}') GROUP BY 1 HAVING count(*) = 1) SELECT visita_id FROM ({VISITS}) v WHERE coords_fuente = 'exif' OR consecutivo IN (SELECT consecutivo FROM e)")
def settled_visits(spark: SparkSession, sf_dir: str) -> DataFrame:
    return loaders.settled_visits(sites(spark, sf_dir), visits(spark, sf_dir))


@query(f"{_PRE}, f AS (SELECT visita_id, sitio_id, 'handshake' AS match_method, score, 0 AS tier FROM ({_TIER_SQL['handshake']}) UNION ALL SELECT visita_id, sitio_id, 'vector', score, 1 FROM ({_TIER_SQL['vector']})) SELECT v.visita_id, sitio_id, match_method, CAST(score AS DOUBLE) AS match_score FROM vh v JOIN (SELECT * FROM f QUALIFY row_number() OVER (PARTITION BY visita_id ORDER BY tier) = 1) b ON b.visita_id = v.visita_id")
def first_generation_exact(spark: SparkSession, sf_dir: str) -> DataFrame:
    return earlier.first_generation(*both(spark, sf_dir), fuzzy=False).where("match_method is not null")


@query()
def generations_compared(spark: SparkSession, sf_dir: str) -> DataFrame:
    v, e = both(spark, sf_dir)
    return earlier.compared(earlier.first_generation(v, e), linkage.cascade(v, e))


@query(f"{_ALL} SELECT v.visita_id FROM vh v LEFT JOIN final f ON f.visita_id = v.visita_id AND f.sitio_id IS NOT NULL WHERE f.visita_id IS NULL AND trim(coalesce(v.direccion_norm, '')) NOT IN ('', '-')")
def unmatched_with_address(spark: SparkSession, sf_dir: str) -> DataFrame:
    m, v, _ = matched(spark, sf_dir)
    return earlier.unmatched_with_address(v, m).select("visita_id")


@query(f"WITH c AS (SELECT o_custkey AS k, o_orderkey AS pos, (o_orderkey % 100) / 100.0::DOUBLE AS trust FROM orders) SELECT k AS visita_id, pos, trust FROM (SELECT * FROM c QUALIFY row_number() OVER (PARTITION BY k ORDER BY trust DESC, pos) = 1) WHERE trust >= 0.50 AND trust < 0.70")
def review_band(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("visita_id"), F.col("o_orderkey").alias("pos"), ((F.col("o_orderkey") % 100) / F.lit(100.0)).alias("trust"))
    return earlier.review_band(c)


@query("SELECT o_custkey AS visita_id, least(count(*), 5) AS n, least(count(*) FILTER (WHERE o_orderkey % 3 = 0), 5) AS dificiles FROM orders GROUP BY 1")
def negative_samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("visita_id"), F.col("o_orderkey").alias("pos"))
    return earlier.negatives(p, F.col("pos") % 3 == 0).groupBy("visita_id").agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("pos") % 3 == 0).alias("dificiles"))


@query()
def reranked_matches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The re-ranker on visits with a known site, from a cosine of 0.30 on, with few trees."""
    v, e = both(spark, sf_dir)
    pairs = written(calibrated.rerank_features(written(calibrated.rerank_candidates(v, e), "candidates"), v, e), "pairs")
    truth = visits(spark, sf_dir).select("visita_id", "true_pos")
    labelled = pairs.join(truth, "visita_id").withColumn("label", (F.col("pos") == F.col("true_pos")).cast("double")).drop("true_pos")
    names = [c for c in pairs.columns if c.startswith("f_")]
    return calibrated.reranked(calibrated.fit(labelled, names, trees=10, folds=2)(pairs), v, e)


@query()
def run_statistics(spark: SparkSession, sf_dir: str) -> DataFrame:
    from siteweave.operators import integrate

    m, v, e = matched(spark, sf_dir)
    return exports.statistics(m, integrate.integrated(integrate.master(e, m, v)), {"version": 2})


@query("SELECT n_nationkey AS k, n_name FROM nation UNION ALL SELECT 0, '' FROM range(15)")
def padded_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    out = sinks.padded(n, "n_nationkey", 40, 1)
    return out.select(F.coalesce(F.col("n_nationkey").try_cast("long"), F.lit(0).cast("long")).alias("k"), "n_name")


@query("SELECT c_custkey AS pos, c_name AS x, row_number() OVER (ORDER BY c_acctbal DESC, c_custkey) AS n FROM customer")
def ranked_accounts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A global rank without one task that sees all rows."""
    from siteweave.operators.order import numbered

    c = table(spark, sf_dir, "customer")
    return numbered(c.select(F.col("c_custkey").alias("pos"), F.col("c_name").alias("x"), "c_acctbal"), [-F.col("c_acctbal"), F.col("pos")], "n").select("pos", "x", "n")
