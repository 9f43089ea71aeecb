"""Reports that cross critical records with inspections, points of the field manager and surveys, by zone and as a whole."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siteweave.functions.coords import haversine_m, parse_latlon
from siteweave.functions.text import addr_key
from siteweave.operators.crossmatch import OUTSIDE, by_address, by_id_or_near
from siteweave.operators.geo import containing, in_ring, nearest
from siteweave.operators.order import numbered
from siteweave.operators.triage import short_id
from siteweave.shared import written

# Radii in metres, and the states of a point that is still to be visited.
DONE_M, SURVEY_M = 40.0, 20.0
PENDING = ("PENDIENTE", "EN_ATENCION")


def manager_polygons(zones: DataFrame) -> DataFrame:
    """(pos, zona_id, rings) of zones (pos, zona_id, poligono): a JSON list of [lat, lon]; others have no polygon."""
    ring = F.from_json("poligono", "array<array<double>>")
    shaped = zones.where("zona_id is not null and zona_id <> ''").withColumn("_ring", ring).where(F.size("_ring") >= 3)
    return shaped.select("pos", "zona_id", F.array(F.transform("_ring", lambda p: F.struct(F.get(p, F.lit(1)).alias("x"), F.get(p, F.lit(0)).alias("y")))).alias("rings"))


def with_inspection(records: DataFrame, evaluations: DataFrame, key: str = "registro_id") -> DataFrame:
    """records (key, lat, lon, direccion) with the inspection that has been made: the nearest within DONE_M, or else by address.

    evaluations: pos, global_id, fecha, severidad, habitabilidad, rlat, rlon, direccion.
    """
    points = evaluations.select("pos", "rlat", "rlon")
    near = nearest(records.select(key, "lat", "lon"), points, key, DONE_M, "pos").select(key, "pos", F.col("dist_m").alias("d"), F.lit("geo").alias("via"))
    rest = records.join(near.select(key), key, "left_anti").select(key, addr_key(F.col("direccion")).alias("akey"), "lat", "lon")
    keyed = evaluations.select("pos", addr_key(F.col("direccion")).alias("rkey"), "rlat", "rlon")
    met = by_address(rest, keyed, key).join(rest.select(key, "lat", "lon"), key).join(points, "pos")
    met = met.select(key, "pos", haversine_m(F.col("lat"), F.col("lon"), F.col("rlat"), F.col("rlon")).alias("d"), "via")
    told = evaluations.select("pos", *(F.col(a).alias(b) for a, b in (("global_id", "f3_global_id"), ("fecha", "f3_fecha"), ("severidad", "f3_severidad"), ("habitabilidad", "f3_habitabilidad"))))
    hit = near.unionByName(met).join(told, "pos").select(F.col(key).alias("_k"), "f3_global_id", "f3_fecha", "f3_severidad", "f3_habitabilidad", F.round("d", 1).alias("f3_dist_m"), F.col("via").alias("f3_match_via"))
    out = records.join(hit, F.col(key) == F.col("_k"), "left")
    return out.withColumn("f3_hecha", F.col("_k").isNotNull()).drop("_k")


def with_point_state(records: DataFrame, points: DataFrame, key: str = "registro_id") -> DataFrame:
    """records with the state of the manager's nearest point (pos, estado, rlat, rlon) within DONE_M."""
    near = nearest(records.select(key, "lat", "lon"), points.select("pos", "rlat", "rlon", "estado"), key, DONE_M, "pos")
    return records.join(near.select(F.col(key).alias("_k"), F.col("estado").alias("punto_estado")), F.col(key) == F.col("_k"), "left").drop("_k")


def with_zone(records: DataFrame, zones: DataFrame, key: str = "registro_id") -> DataFrame:
    """records with the first zone whose polygon holds them, or else the one they name, and zona_via."""
    inside = containing(records.select(key, "lat", "lon"), manager_polygons(zones).withColumnRenamed("zona_id", "_zona"), key, lambda rings, x, y: in_ring(rings[0], x, y))
    own = F.when(F.coalesce(F.col("zona_id"), F.lit("")) != "", F.col("zona_id"))
    out = records.join(inside.select(F.col(key).alias("_k"), "_zona"), F.col(key) == F.col("_k"), "left")
    named = out.withColumns({"zona_via": F.when(F.col("_zona").isNotNull(), "poligono").when(own.isNotNull(), "roster"), "zona_id": F.coalesce("_zona", own)})
    return named.drop("_k", "_zona")


def manager_cross(roster: DataFrame, zones: DataFrame, evaluations: DataFrame, points: DataFrame) -> DataFrame:
    """The roster's records (registro_id, lat, lon, direccion, zona_id, ...) with zone, inspection and state of the point."""
    return with_point_state(with_inspection(with_zone(roster, zones), evaluations), points)


def manager_rollup(zones: DataFrame, crossed: DataFrame, dispatches: DataFrame, points: DataFrame) -> DataFrame:
    """A row for each zone (zona_id, comuna, lider, estado, n_puntos), and one for what lies outside all; most missing first."""
    known = crossed.join(zones.select("zona_id", F.lit(True).alias("_in")).distinct(), "zona_id", "left")
    zone = F.when(F.col("_in"), F.col("zona_id")).otherwise(OUTSIDE)
    counts = known.groupBy(zone.alias("_z")).agg(F.count(F.lit(1)).alias("n_criticos"), F.count_if("f3_hecha").alias("n_f3_hechas"))
    waiting = points.where(F.upper("estado").isin(*PENDING)).groupBy(F.col("zona_id").alias("_z")).agg(F.count(F.lit(1)).alias("gestor_pendientes"))
    today = dispatches.where("zona_id is not null and zona_id <> ''").select(F.col("zona_id").alias("_z"), F.lit(True).alias("despacho_hoy")).distinct()
    named = zones.where("zona_id is not null and zona_id <> ''").select(F.col("zona_id").alias("_z"), "comuna", "lider", F.col("estado").alias("estado_zona"), F.coalesce(F.col("n_puntos").try_cast("int"), F.lit(0)).alias("gestor_n_puntos"))
    outside = counts.where(F.col("_z") == OUTSIDE).select("_z", F.lit("").alias("comuna"), F.lit("").alias("lider"), F.lit("").alias("estado_zona"), F.lit(0).alias("gestor_n_puntos"))
    out = named.unionByName(outside).join(counts, "_z", "left").join(waiting, "_z", "left").join(today, "_z", "left")
    out = out.na.fill(0, ["n_criticos", "n_f3_hechas", "gestor_pendientes"]).na.fill(False, ["despacho_hoy"]).withColumn("n_faltantes", F.col("n_criticos") - F.col("n_f3_hechas"))
    return out.select(F.col("_z").alias("zona_id"), "comuna", "lider", "estado_zona", "despacho_hoy", "n_criticos", "n_f3_hechas", "n_faltantes", "gestor_n_puntos", "gestor_pendientes").orderBy(F.desc("n_faltantes"), "zona_id")


def manager_summary(crossed: DataFrame, points: DataFrame, dispatches: DataFrame) -> DataFrame:
    """One row that the roll-up's rows add up to."""
    via = lambda v: F.count_if(F.col("f3_match_via") == v)
    a = crossed.agg(F.count(F.lit(1)).alias("total_criticos"), F.count_if("f3_hecha").alias("f3_hechas"), via("direccion").alias("f3_por_direccion"), via("combinado").alias("f3_por_combinado"), F.count_if(F.col("zona_via") == "poligono").alias("zona_por_poligono"), F.count_if(~F.col("f3_hecha")).alias("f3_faltantes"))
    b = points.agg(F.count(F.lit(1)).alias("gestor_puntos_totales"), F.count_if(F.upper("estado").isin(*PENDING)).alias("gestor_puntos_pendientes"))
    c = dispatches.where("zona_id is not null and zona_id <> ''").agg(F.countDistinct("zona_id").alias("zonas_con_despacho_hoy"))
    return a.crossJoin(b).crossJoin(c)  # one row each


def survey_cross(critical: DataFrame, survey: DataFrame, zones: DataFrame | None = None, key: str = "registro_id") -> DataFrame:
    """Critical records with the survey that covers them: by global id, within SURVEY_M, or by address; estado, match, distance.

    critical: registro_id, sitio_id, coords_unificadas, direccion_unificada. survey: pos, gid, rlat, rlon, rkey, fecha,
    evaluador. zones: as containing() takes them, with zona_id.
    """
    p = parse_latlon(F.col("coords_unificadas"))
    here = critical.withColumns({"lat": p["lat"], "lon": p["lon"]})
    # What several steps read is written: points are parsed once, addresses once and only where no point was near.
    asked = written(here.select(key, F.coalesce("sitio_id", F.lit("")).alias("origin"), "direccion_unificada", "lat", "lon"), "asked")
    met = written(by_id_or_near(asked.select(key, "origin", "lat", "lon"), survey.select("gid", "rlat", "rlon"), key, SURVEY_M), "met")
    rest = written(asked.join(met.where("not found").select(key), key, "left_semi").select(key, addr_key(F.col("direccion_unificada")).alias("akey"), "lat", "lon"), "rest")
    told = by_address(rest, survey.select("pos", "rkey", "rlat", "rlon"), key).join(rest.select(key, "lat", "lon"), key).join(survey.select("pos", "gid", "rlat", "rlon"), "pos")
    told = told.select(F.col(key).alias("_k"), F.col("gid").alias("_gid"), "via", F.round(haversine_m(F.col("lat"), F.col("lon"), F.col("rlat"), F.col("rlon"))).cast("long").alias("_dist"))
    both = met.select(key, "gid", F.when(F.col("found"), F.col("via")).alias("via1"), "dist").join(told, F.col(key) == F.col("_k"), "left")
    match = F.coalesce("via1", "via")
    both = both.select(F.col(key).alias("_r"), F.coalesce("gid", "_gid").alias("survey_globalid"), match.alias("match"), F.coalesce("dist", "_dist").alias("dist_m"))
    dates = survey.select(F.col("gid").alias("survey_globalid"), F.col("fecha").alias("survey_fecha"), F.col("evaluador").alias("survey_evaluador")).dropDuplicates(["survey_globalid"])
    both = both.join(dates, "survey_globalid", "left")
    out = here.join(both, F.col(key) == F.col("_r"), "left").drop("_r").withColumns({"estado_cruce": F.when(F.col("match").isNull(), "pendiente").otherwise("levantado"), "clave_integracion": short_id(F.trim(key))})
    if zones is None:
        return out.withColumn("zona_id", F.lit(""))
    from siteweave.operators.geo import covered

    inside = containing(out.select(key, "lat", "lon"), zones.select("pos", F.col("zona_id").alias("_z"), "rings"), key, covered).select(F.col(key).alias("_r"), "_z")
    return out.drop("zona_id").join(inside, F.col(key) == F.col("_r"), "left").withColumn("zona_id", F.coalesce("_z", F.lit(""))).drop("_r", "_z")


def survey_rollup(crossed: DataFrame) -> DataFrame:
    """Records, covered and pending ones by zone; the largest first."""
    done = F.col("estado_cruce") == "levantado"
    zone = F.when(F.col("zona_id") == "", OUTSIDE).otherwise(F.col("zona_id"))
    return crossed.groupBy(zone.alias("zona_id")).agg(F.count(F.lit(1)).alias("n_criticos"), F.count_if(done).alias("n_levantados"), F.count_if(~done).alias("n_pendientes")).orderBy(F.desc("n_criticos"), "zona_id")


def survey_summary(crossed: DataFrame, survey: DataFrame) -> DataFrame:
    done, via = F.col("estado_cruce") == "levantado", lambda v: F.count_if(F.col("match") == v)
    a = crossed.agg(F.count(F.lit(1)).alias("total_criticos"), F.count_if(done).alias("levantados"), F.count_if(~done).alias("pendientes"), *(via(v).alias(f"por_{v}") for v in ("globalid", "cercania", "direccion", "combinado")), F.countDistinct("survey_globalid").alias("survey_usados"))
    return a.crossJoin(survey.agg(F.count(F.lit(1)).alias("survey_puntos")))  # one row each


def inspection_cascade(records: DataFrame, inspections: DataFrame, cascade, prepare) -> DataFrame:
    """Integrated records against inspections through the linkage cascade: a row for each pair, each record without one once,
    and each inspection that no record has.

    records: registro_id, sitio_id, visita_id, direccion_unificada, barrio_unificado, comuna_unificada, coords_unificadas,
    tipo_estructura_edan, tipo_estructura_visita. inspections: id_edan, direccion_norm, barrio_vereda, comuna, coords,
    uso_edificacion. Site order is that of the ids.
    """
    def framed(df: DataFrame, key: str, address: str, area: str, coords: str, name: str) -> DataFrame:
        p = parse_latlon(F.col(coords))
        return df.select(F.col(key).alias(name), F.col(address).alias("direccion_norm"), F.col(area).alias("barrio"), p["lat"].alias("lat"), p["lon"].alias("lon"), F.lit("tecleada").alias("coords_fuente"), F.lit("").alias("consecutivo"))

    e = framed(records, "registro_id", "direccion_unificada", "barrio_unificado", "coords_unificadas", "sitio_id")
    e = numbered(e, [F.col("sitio_id")], "pos") if "pos" not in records.columns else e.join(records.select(F.col("registro_id").alias("sitio_id"), "pos"), "sitio_id")
    v = framed(inspections, "id_edan", "direccion_norm", "barrio_vereda", "coords", "visita_id")
    # Written, as each tier reads both sides: addresses are parsed once.
    v, e = written(prepare(v), "inspections"), written(prepare(e), "records")
    found = cascade(v, e).where("sitio_id is not null").select(F.col("sitio_id").alias("_r"), F.col("visita_id").alias("edan_id"), "match_method", "match_score")
    kind = lambda c: F.trim(F.coalesce(F.col(c), F.lit("")))
    base = records.select("registro_id", "sitio_id", "visita_id", F.col("direccion_unificada").alias("direccion"), F.col("barrio_unificado").alias("barrio_vereda"), F.col("comuna_unificada").alias("comuna_corregimiento"), F.col("coords_unificadas").alias("coords"), F.when(kind("tipo_estructura_edan") != "", kind("tipo_estructura_edan")).otherwise(kind("tipo_estructura_visita")).alias("tipo_estructura"))
    met = base.join(found, F.col("registro_id") == F.col("_r"), "left")
    pair = F.when(F.col("edan_id").isNotNull(), F.concat_ws("-", "registro_id", "edan_id")).otherwise(F.col("registro_id"))
    met = met.withColumns({"registro_id": pair, "edan_id": F.coalesce("edan_id", F.lit("")), "match_method": F.coalesce("match_method", F.lit(""))}).drop("_r")
    alone = inspections.join(found.select(F.col("edan_id").alias("id_edan")).distinct(), "id_edan", "left_anti")
    alone = alone.select(*(F.lit("").alias(c) for c in ("registro_id", "sitio_id", "visita_id")), F.col("direccion_norm").alias("direccion"), "barrio_vereda", F.col("comuna").alias("comuna_corregimiento"), "coords", kind("uso_edificacion").alias("tipo_estructura"), F.col("id_edan").alias("edan_id"), F.lit("solo_f3").alias("match_method"), F.lit(None).cast("double").alias("match_score"))
    return met.select(alone.columns).unionByName(alone)
