"""The persistent roster of records to visit: place, zone, age, inspection, score and priority, and its counters."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siteweave.functions.coords import parse_latlon
from siteweave.functions.text import district
from siteweave.operators.crossmatch import by_id_or_near
from siteweave.operators.geo import containing, covered
from siteweave.operators.order import numbered
from siteweave.operators.triage import WEIGHTS, demolition_value, graph_severity, min_max, risk_value, short_id, victim_factor, wave_value
from siteweave.shared import written

# The columns of the published roster, those of the web export beside them, and the texts that tell damage.
PUBLISHED = ("prioridad", "estado_visita", "id_asignacion", "score", "registro_id", "direccion", "comuna_corregimiento", "barrio_vereda", "coords", "zona_id", "ola", "despacho", "nivel_riesgo", "estado_estructura", "grafo_severidad", "n_fallecidos", "n_atrapamientos", "n_rescatados", "requiere_demolicion", "antiguedad_dias", "timestamp_registro", "flags", "fecha_corrida")
WEB = ("lat", "lon", "ede_hecha", "ede_match", "ede_fecha", "ede_dist_m")
DAMAGE_TEXTS = ("descripcion_edan", "descripcion_visita", "estado_estructura", "nombre_estructura")
INSPECTION_M, ZONE = 40.0, "America/Bogota"


def number(c: Column) -> Column:
    """A typed number, decimal commas too; 0 for what is none."""
    return F.coalesce(F.regexp_replace(c.cast("string"), ",", ".").try_cast("double"), F.lit(0.0))


def column(df: DataFrame, name: str, kind: str = "string") -> Column:
    """The column, or nulls where df lacks it."""
    return F.col(name).cast(kind) if name in df.columns else F.lit(None).cast(kind)


def resolved_time(records: DataFrame, visit_times: DataFrame) -> DataFrame:
    """records with `ts`, local time: the evaluation's own, in milliseconds, or else that of the visit's form (visita_id, ts)."""
    raw = F.trim(F.coalesce(column(records, "evaluacion_creado_utc"), F.lit("")))
    own = F.from_utc_timestamp(F.timestamp_millis(raw.try_cast("long")), ZONE)
    forms = visit_times.groupBy(F.col("visita_id").alias("_v")).agg(F.max("ts").alias("_form"))
    out = records.withColumn("_own", own).join(forms, F.trim(column(records, "visita_id")) == F.col("_v"), "left")
    return out.withColumn("ts", F.coalesce("_own", "_form")).drop("_own", "_form", "_v")


def located(records: DataFrame) -> DataFrame:
    """records with lat and lon as numbers: their own, or those of the text in coords_unificadas or coords; others are left out."""
    text = next((c for c in ("coords_unificadas", "coords") if c in records.columns), None)
    point = parse_latlon(F.col(text)) if text else F.lit(None).cast("struct<lat:double,lon:double>")
    lat, lon = (column(records, c).try_cast("double") for c in ("lat", "lon"))
    own = lat.isNotNull() & lon.isNotNull() & ~F.isnan(lat) & ~F.isnan(lon)
    out = records.withColumns({"_p": F.when(own, F.struct(lat.alias("lat"), lon.alias("lon"))).otherwise(point), "coords": F.coalesce(F.col(text), F.lit("")) if text else F.lit("")})
    return out.withColumns({"lat": F.col("_p.lat"), "lon": F.col("_p.lon")}).drop("_p").where("lat is not null and lon is not null")


def zoned(records: DataFrame, zones: DataFrame | None, key: str) -> DataFrame:
    """records with zona_id, ola and despacho of the first zone (pos, zona_id, ola, despacho, rings) that holds the point, borders
    included; empty outside all."""
    if zones is None:
        return records.withColumns(dict.fromkeys(("zona_id", "ola", "despacho"), F.lit("")))
    inside = containing(records.select(key, "lat", "lon"), zones.select("pos", "rings", *(F.col(c).alias(f"_{c}") for c in ("zona_id", "ola", "despacho"))), key, covered)
    out = records.drop("zona_id", "ola", "despacho").join(inside.select(key, "_zona_id", "_ola", "_despacho"), key, "left")
    return out.select(*(c for c in out.columns if c not in ("_zona_id", "_ola", "_despacho")), *(F.coalesce(f"_{c}", F.lit("")).alias(c) for c in ("zona_id", "ola", "despacho")))


def assignments(records: DataFrame, done: DataFrame, visit_times: DataFrame, now: str, terms: DataFrame, zones: DataFrame | None = None, inspections: DataFrame | None = None, top: int | None = None) -> DataFrame:
    """The roster: a row for each record with a place, pending ones first by priority, then the visited ones without a number.

    done: (registro_id) of visited records. visit_times: (visita_id, ts). now: local time of the run. terms: (pattern, weight)
    of the damage graph. inspections: (gid, rlat, rlon, fecha), or None where they could not be read: then ede_hecha is null.
    top: as many pending records at most; visited ones always stay. Two records whose short ids agree are an error when the
    roster is written (see checked()).
    """
    at = F.lit(now).cast("timestamp")
    # Written at the two places where several later steps start from: place, zone, score and inspection read the first table, both
    # parts of the roster the second.
    base = written(resolved_time(located(records), visit_times), "located")
    text = F.concat_ws(" ", *(F.coalesce(column(base, c), F.lit("")) for c in DAMAGE_TEXTS))
    base = graph_severity(base.withColumn("_text", text), terms, "_text").drop("_text")
    seen = done.select(F.trim("registro_id").alias("_done")).where("_done <> ''").distinct()
    base = base.join(seen, F.trim("registro_id") == F.col("_done"), "left").withColumn("visited", F.col("_done").isNotNull()).drop("_done")
    base = written(zoned(base, zones, "registro_id"), "zoned")
    age = (F.unix_micros(at) - F.unix_micros("ts")) / 86_400e6
    victims = {n: number(column(base, f"n_{n}_total")) for n in ("fallecidos", "atrapamientos", "rescatados")}
    base = base.withColumns({"age_days": age, **{f"_{n}": c for n, c in victims.items()}})
    base = min_max(base, "age_days", "_age", ~F.col("visited"))
    risk, demolition = column(base, "nivel_riesgo"), column(base, "requiere_demolicion")
    parts = {"severity": F.col("severity"), "victims": victim_factor(F.col("_fallecidos"), F.col("_atrapamientos"), F.col("_rescatados")), "age": F.col("_age"), "risk": risk_value(risk), "demolition": demolition_value(demolition), "wave": wave_value(F.col("ola"))}
    base = base.withColumn("score", F.round(sum((WEIGHTS[k] * c for k, c in parts.items()), F.lit(0.0)), 1))
    met = by_id_or_near(base.select("registro_id", F.coalesce(column(base, "sitio_id"), F.lit("")).alias("origin"), "lat", "lon"), inspections, "registro_id", INSPECTION_M) if inspections is not None else base.select("registro_id", F.lit(None).cast("string").alias("gid"), F.lit(None).cast("string").alias("via"), F.lit(None).cast("long").alias("dist"), F.lit(None).cast("boolean").alias("found"))
    dates = inspections.select("gid", F.col("fecha").alias("ede_fecha")).dropDuplicates(["gid"]) if inspections is not None else met.sparkSession.createDataFrame([], "gid string, ede_fecha string")
    met = met.join(dates, "gid", "left").select(F.col("registro_id").alias("_r"), F.col("found").alias("ede_hecha"), F.when(F.col("via") != "", F.col("via")).alias("ede_match"), "ede_fecha", F.col("dist").alias("ede_dist_m"))
    base = base.join(met, F.col("registro_id") == F.col("_r"), "left").drop("_r")
    words = lambda c: F.coalesce(column(base, c), F.lit(""))
    out = base.select(
        F.when(F.col("visited"), "visitado").otherwise("pendiente").alias("estado_visita"), short_id(F.col("registro_id")).alias("id_asignacion"), "score", "registro_id", words("direccion_unificada").alias("direccion"),
        district(words("comuna_unificada")).alias("comuna_corregimiento"), words("barrio_unificado").alias("barrio_vereda"), "coords", "zona_id", "ola", "despacho", words("nivel_riesgo").alias("nivel_riesgo"), words("estado_estructura").alias("estado_estructura"),
        F.round("severity", 2).alias("grafo_severidad"), *(F.col(f"_{n}").cast("int").alias(f"n_{n}") for n in victims), words("requiere_demolicion").alias("requiere_demolicion"), F.round("age_days", 1).alias("antiguedad_dias"),
        F.coalesce(F.date_format("ts", "yyyy-MM-dd HH:mm"), F.lit("")).alias("timestamp_registro"), F.array_join(F.array_compact(F.array(F.when(F.col("zona_id") == "", "fuera_de_zona"), F.when(F.col("ts").isNull(), "sin_timestamp"))), ",").alias("flags"),
        F.date_format(at, "yyyy-MM-dd HH:mm").alias("fecha_corrida"), F.round("lat", 6).alias("lat"), F.round("lon", 6).alias("lon"), "ede_hecha", "ede_match", "ede_fecha", "ede_dist_m", F.coalesce("age_days", F.lit(-1.0)).alias("_sort"),
    )
    out = written(out, "roster")
    pending = numbered(out.where("estado_visita = 'pendiente'"), [-F.col("score"), -F.col("_sort"), F.col("registro_id")], "prioridad")
    pending = pending.withColumn("prioridad", F.col("prioridad").cast("int"))
    if top is not None:
        pending = pending.where(F.col("prioridad") <= top)
    visited = out.where("estado_visita = 'visitado'").withColumn("prioridad", F.lit(None).cast("int"))
    return pending.unionByName(visited).select(*PUBLISHED, *WEB)


def published_order(roster: DataFrame) -> DataFrame:
    """The rows as they are published: by priority, then the visited ones by falling score."""
    return roster.orderBy(F.col("prioridad").asc_nulls_last(), F.desc("score"), "registro_id")


def checked(roster: DataFrame) -> DataFrame:
    """roster, or an error if two records share a short id."""
    if roster.groupBy("id_asignacion").count().where("count > 1").limit(1).count():
        raise ValueError("two records share an id_asignacion: it needs more digits")
    return roster


def counters(roster: DataFrame) -> DataFrame:
    """One row of counts; those of inspections are null if none could be looked up."""
    known = F.bool_or(F.col("ede_hecha").isNotNull())
    pending = F.when(F.col("estado_visita") == "pendiente", F.col("score"))
    return roster.agg(
        F.count(F.lit(1)).alias("filas"), F.count_if(F.col("estado_visita") == "pendiente").alias("pendientes"), F.count_if(F.col("estado_visita") == "visitado").alias("visitados"), F.count_if(F.col("grafo_severidad") > 0).alias("con_grafo"),
        F.count_if(F.col("n_fallecidos") + F.col("n_atrapamientos") + F.col("n_rescatados") > 0).alias("con_victimas"), F.when(known, F.count_if("ede_hecha")).alias("ede_hechas"), F.when(known, F.count_if(~F.col("ede_hecha"))).alias("ede_pendientes"), F.max(pending).alias("score_max"), F.min(pending).alias("score_min"),
    )
