"""The engine's inputs from their landings: both typed sheets, critical cases, surveys, inspections, the field manager, the
damage graph, photo listings and geocoder answers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from siteweave.functions import text
from siteweave.functions.coords import coords_text, parse_coords, parse_latlon
from siteweave.operators.crossmatch import latest
from siteweave.sources.readers import cases as _cases  # noqa: F401  the short form
from siteweave.sources.readers import fill_ids, local_date, not_empty, recover_header, rename, text_table

# Headers of the typed sheets, what they become, and the columns that are dropped, title-cased or told by how
# they begin.
SITE_DROP = ("DESCRIPCION CENTRALIZADA", "REFERENCIADO EN EL MAPA", "Direccion", "Color semaforo")
SITE_NAMES = {
    "ID": "consecutivo_edan", "Prioridad": "prioridad", "Estado": "estado", "Comuna - Corregimiento": "comuna_corregimiento", "Zona": "zona", "Barrio": "barrio_vereda", "Tipo": "tipo_estructura", "Referencia": "punto_referencia",
    "DIRECCION COMPLETA": "direccion", "Descripción": "descripcion", "Normalizacion": "normalizacion", "Personas Evacuadas": "n_personas_evacuadas", "Seres sintientes": "n_seres_sintientes", "Atencion de la respuesta": "personal_atencion",
    "Colapso Total": "n_colapsados_total", "Colapso Parcial": "n_colapsados_parcial", "Daños": "n_danos", "Atrapamientos": "n_atrapamientos", "Rescatados": "n_rescatados", "Fallecidos": "n_fallecidos", "NOMBRE DELEGADO": "nombre_delegado",
    "OBSERVACIONES (Gestiòn del riesgo)": "observaciones_gred", "DESAPARECIDOS": "n_desaparecidos", "COORDENADAS": "coords", "DESCRIPCION DE LA SITUACION": "descripcion_2", "Observaciones generales (FORMULARIO)": "observaciones_generales",
    "NOMBRE LIDER": "nombre_lider", "TELEFONO": "num_telefono", "GRUPO ": "grupo",
}
SITE_TITLES = ("prioridad", "direccion", "nombre_lider", "nombre_delegado")
VISIT_DROP, VISIT_DROP_BY_START = ("Columna 22", "Columna 1", "Colapso"), "Marque con una X"
VISIT_NAMES = {
    "Marca temporal": "timestamp", "Dirección de correo electrónico": "email", "Dirección completa": "direccion", "Coordenadas Geográficas": "coords", "Descripción completa de la situación encontrada": "descripcion",
    "Cantidad de personas fallecidos (EN NÚMEROS POR FAVOR)": "n_fallecidos", "Cantidad de personas atrapadas  (EN NÚMEROS POR FAVOR)": "n_atrapamientos", "Cantidad de personas rescatadas  (EN NÚMEROS POR FAVOR)": "n_rescatados",
    "Suba los soportes que considere necesarios (Vídeos, fotos, audios, documentos)": "evidencia_soporte", "Nombre de la persona que diligencia el reporte": "nombre_diligenciador", "¿Se necesita evacuación preventiva de las personas?": "evacuacion_preventiva",
    "Nombre del organismo que pertenece. \n\nEn caso de ser parte del grupo de ingenieros y arquitectos voluntarios ir a la siguiente pregunta": "nombre_organismo", "Nivel de riesgo ": "nivel_riesgo", "Consecutivo - id (solo si fue asignado)": "consecutivo_gred",
    "¿La edificación requiere demolición?": "requiere_demolicion", "Describa las observaciones que considere pertinentes a la pregunta anterior": "observaciones", "Requieren evacuación": "requieren_evacuacion", "Observaciones generales": "observaciones_generales",
    "Comuna": "comuna_corregimiento", "Barrio": "barrio_vereda", "Tipo de edificación atendida": "tipo_estructura", "Situación de la vivienda": "estado_estructura",
}
VISIT_NAMES_BY_START = {"cantidad de personas aproximadas": "personas_necesitan_evacuar", "cantidad de casas": "n_estructuras_caracterizadas", "nombre del edificio": "nombre_estructura"}
VISIT_TITLES = ("barrio_vereda", "comuna_corregimiento", "tipo_estructura", "nombre_diligenciador", "nombre_estructura", "estado_estructura", "requiere_demolicion", "direccion")
CASE_COLUMNS = (
    "registro_id", "fuente", "sitio_id", "visita_id", "direccion_unificada", "barrio_unificado", "comuna_unificada", "coords_unificadas", "tipo_estructura_edan", "tipo_estructura_visita", "nombre_estructura", "nivel_riesgo", "estado", "estado_estructura",
    "requiere_demolicion", "n_fallecidos_total", "n_atrapamientos_total", "n_rescatados_total", "descripcion_edan", "descripcion_visita", "evaluacion_creado_utc",
)
CASE_SCHEMA = (
    "id string, estado string, estadoEtiqueta string, direccion string, lat double, lng double, placeId string, comuna string, comunaEtiqueta string, barrio string, resumenUnidad string, ingreso struct<tipoInmuebleEtiqueta:string,descripcion:string>, "
    "inmueble struct<tipoInmuebleEtiqueta:string,nombreEdificio:string>, evaluacion struct<id:string,creado_utc:bigint,tipoColapso:string,tipoColapsoEtiqueta:string,tipoInmuebleEtiqueta:string,habitabilidadEtiqueta:string,conceptoTecnico:string,victimas:struct<fallecidos:string,atrapados:string,rescatados:string>>"
)
SITE_SEED, VISIT_SEED, CITY_NAME = 42, 88, "Cali"


def grouped_after(columns: list[str], anchor: str, start: str = "n_") -> list[str]:
    """The columns in order, those that begin with `start` gathered where the anchor stands."""
    if anchor not in columns:
        return columns
    at = columns.index(anchor)
    plain = lambda part: [c for c in part if not c.startswith(start)]
    return [*plain(columns[:at]), *(c for c in columns if c.startswith(start)), *plain(columns[at:])]


def titled(df: DataFrame, *names: str) -> DataFrame:
    return df.withColumns({c: text.title_case(F.coalesce(F.col(c), F.lit(""))) for c in names if c in df.columns})


def with_handshake(df: DataFrame, column: str = "direccion_norm") -> DataFrame:
    """df with integration_handshake right after the address: the compact form and the vector's three numbers."""
    vec = text.address_vector(F.col(column))
    pair = F.struct(text.handshake(F.col(column)).alias("handshake"), F.array(vec["road"], vec["cross"], vec["plate"]).alias("vector"))
    at = df.columns.index(column) + 1
    return df.select(*df.columns[:at], pair.alias("integration_handshake"), *df.columns[at:])


def _placed(df: DataFrame, column: str, after: str, value: Column) -> DataFrame:
    cols = [c for c in df.columns if c != column]
    at = cols.index(after) + 1
    return df.select(*cols[:at], value.alias(column), *cols[at:])


def _wgs84(df: DataFrame) -> DataFrame:
    """Coordinates as `lat, lon`; what can't be read stays."""
    found = coords_text(parse_coords(F.col("coords")))
    return df.withColumn("coords", F.when(found != "", found).otherwise(F.col("coords"))) if "coords" in df.columns else df


def _with_ids(df: DataFrame, column: str, seed: int) -> DataFrame:
    if column not in df.columns:
        df = df.withColumn(column, F.lit(""))
    filled = fill_ids(df.withColumn("_pos", F.monotonically_increasing_id()), column, "_pos", seed)
    return filled.orderBy("_pos").drop("_pos").select(column, *(c for c in df.columns if c != column))


def load_sites(raw: DataFrame, seed: int = SITE_SEED) -> DataFrame:
    """The sites' sheet as text: headers told and renamed, annulled and empty rows left out (a row with nothing but its number is
    empty), ids filled, counts gathered, the normalized address and its handshake, coordinates as `lat, lon`."""
    df = raw.toDF(*recover_header(raw.columns)).drop(*SITE_DROP)
    df = titled(rename(df, SITE_NAMES), *SITE_TITLES)
    df = not_empty(df, ("sitio_id", "consecutivo_edan"))
    df = _with_ids(df, "sitio_id", seed)
    order = grouped_after(df.columns, "n_personas_evacuadas")
    if {"descripcion", "descripcion_2"} <= set(order):
        order = [c for c in order if c != "descripcion_2"]
        order.insert(order.index("descripcion") + 1, "descripcion_2")
    df = df.select(*order)
    df = _placed(df, "direccion_norm", "direccion", text.normalize_address(F.col("direccion")))
    return _wgs84(with_handshake(df))


def load_visits(raw: DataFrame, seed: int = VISIT_SEED) -> DataFrame:
    """The visits' sheet as text: as load_sites(), with the number of linked files and the neighbourhood after the address."""
    df = raw.drop(*(c for c in raw.columns if c in VISIT_DROP or c.startswith(VISIT_DROP_BY_START)))
    df = rename(df, VISIT_NAMES)
    df = df.withColumnsRenamed({c: new for c in df.columns for start, new in VISIT_NAMES_BY_START.items() if c.lower().startswith(start)})
    df = _with_ids(titled(df, *VISIT_TITLES), "visita_id", seed)
    if "evidencia_soporte" in df.columns:
        df = df.withColumn("n_evidencias", F.size(text.file_ids(F.col("evidencia_soporte"))))
    norm, area = F.trim(text.normalize_address(F.col("direccion"))), F.trim(F.coalesce(F.col("barrio_vereda"), F.lit("")))
    full = F.when(norm.isin("", "-"), norm).otherwise(F.concat_ws(", ", norm, F.when(~area.isin("", "-"), area), F.lit(CITY_NAME)))
    return _wgs84(with_handshake(_placed(df, "direccion_norm", "direccion", full)))


def read_sheet(spark: SparkSession, path: str) -> DataFrame:
    return text_table(spark, path)


def flat_cases(df: DataFrame) -> DataFrame:
    """Nested critical cases, with `pos` for their order, as CASE_COLUMNS of text: the newest evaluation of each record."""
    told = lambda *names: F.coalesce(*(F.when(F.col(n).cast("string") != "", F.col(n).cast("string")) for n in names), F.lit(""))
    plain = lambda n: F.coalesce(F.col(n).cast("string"), F.lit(""))
    place = F.when(F.col("lat").isNull() | F.col("lng").isNull(), "").otherwise(F.format_string("%.6f, %.6f", F.col("lat").cast("double"), F.col("lng").cast("double")))
    values = (
        plain("id"), F.lit("api_visitados_criticos"), plain("placeId"), plain("evaluacion.id"), plain("direccion"), plain("barrio"), told("comunaEtiqueta", "comuna"), place, plain("ingreso.tipoInmuebleEtiqueta"), told("evaluacion.tipoInmuebleEtiqueta", "inmueble.tipoInmuebleEtiqueta"),
        told("inmueble.nombreEdificio", "resumenUnidad"), plain("evaluacion.tipoColapsoEtiqueta"), plain("estadoEtiqueta"), plain("evaluacion.habitabilidadEtiqueta"), F.when(F.col("evaluacion.tipoColapso") == "A", "si").otherwise(""), plain("evaluacion.victimas.fallecidos"),
        plain("evaluacion.victimas.atrapados"), plain("evaluacion.victimas.rescatados"), plain("ingreso.descripcion"), plain("evaluacion.conceptoTecnico"), plain("evaluacion.creado_utc"),
    )
    rows = df.select("pos", *(v.alias(c) for v, c in zip(values, CASE_COLUMNS, strict=True)))
    return latest(rows.withColumn("_ts", F.col("evaluacion_creado_utc").try_cast("long")), "registro_id", "_ts", "pos").select(*CASE_COLUMNS)


def fetch_cases(spark: SparkSession, path: str, since: int = 0, until: int | None = None) -> DataFrame:
    """Critical cases of a JSON landing (one case a line) whose evaluation was saved in [since, until], epoch milliseconds; cases
    without an evaluation count as saved at 0."""
    saved = F.coalesce(F.col("evaluacion.creado_utc"), F.lit(0))
    df = spark.read.schema(CASE_SCHEMA).json(path).where(saved >= since)
    return (df if until is None else df.where(saved <= until)).withColumn("pos", F.monotonically_increasing_id())


def load_survey(df: DataFrame) -> DataFrame:
    """(pos, gid, rlat, rlon, direccion, rkey, fecha, evaluador) of surveys with a place (GlobalID, x, y, direccion, direccion_norm, ...)."""
    lat, lon = F.col("y").try_cast("double"), F.col("x").try_cast("double")
    has = lambda n: n in df.columns
    options = [F.when(F.col(n) != "", F.col(n)) for n in ("direccion_norm", "direccion") if has(n)]
    address = F.coalesce(*options, F.lit(None).cast("string")) if options else F.lit(None).cast("string")
    told = lambda n: F.col(n) if has(n) else F.lit(None).cast("string")
    rows = df.where(lat.isNotNull() & lon.isNotNull()).withColumn("pos", F.monotonically_increasing_id())
    return rows.select("pos", text.global_id(F.col("GlobalID")).alias("gid"), lat.alias("rlat"), lon.alias("rlon"), address.alias("direccion"), text.addr_key(address).alias("rkey"), told("fecha_inspeccion").alias("fecha"), told("nombre_evaluador").alias("evaluador"))


def load_inspections(df: DataFrame) -> DataFrame:
    """(gid, rlat, rlon, fecha, evaluador) of the pages of a feature service (features, error); a page with an error is one."""
    if "error" in df.columns and not df.where("error is not null").isEmpty():
        raise ValueError("a page of the inspections' landing holds an error")
    one = df.select(F.explode("features").alias("f"))
    return one.select(text.global_id(F.col("f.attributes.globalid")).alias("gid"), F.col("f.geometry.y").cast("double").alias("rlat"), F.col("f.geometry.x").cast("double").alias("rlon"), F.date_format(local_date(F.col("f.attributes.fecha_inspeccion").cast("string")), "yyyy-MM-dd").alias("fecha"), F.col("f.attributes.nombre_evaluador").alias("evaluador"))


def load_manager(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    """zonas, evaluaciones, puntos and despachosHoy of the field manager's landings, in the engine's names."""
    raw = {n: spark.read.option("multiLine", True).json(f"{folder}/{n}.json").withColumn("pos", F.monotonically_increasing_id()) for n in ("zonas", "evaluaciones", "puntos", "despachosHoy")}
    col = lambda n, c: F.col(c).cast("string") if c in raw[n].columns else F.lit(None).cast("string")
    of = lambda n, *names, **more: raw[n].select("pos", *(col(n, c).alias(a) for c, a in names), *(v.alias(k) for k, v in more.items()))
    number = lambda n, c: col(n, c).try_cast("double")
    return {
        "zonas": of("zonas", ("ZONA_ID", "zona_id"), ("COMUNA", "comuna"), ("LIDER_ACTUAL", "lider"), ("ESTADO_ACTUAL", "estado"), ("N_PUNTOS", "n_puntos"), ("POLIGONO", "poligono")),
        "evaluaciones": of("evaluaciones", ("GLOBAL_ID", "global_id"), ("FECHA_INSPECCION", "fecha"), ("SEVERIDAD", "severidad"), ("HABITABILIDAD", "habitabilidad"), ("DIRECCION", "direccion"), rlat=number("evaluaciones", "Y"), rlon=number("evaluaciones", "X")),
        "puntos": of("puntos", ("ZONA_ID", "zona_id"), ("ESTADO", "estado"), rlat=number("puntos", "LAT"), rlon=number("puntos", "LON")),
        "despachosHoy": of("despachosHoy", ("ZONA_ID", "zona_id")),
    }


def visit_times(df: DataFrame) -> DataFrame:
    """(visita_id, ts) of the visits' sheet, day first; no rows where a column is missing."""
    if not {"visita_id", "Marca temporal"} <= set(df.columns):
        return df.sparkSession.createDataFrame([], "visita_id string, ts timestamp")
    raw = F.trim("Marca temporal")
    ts = F.coalesce(*(F.try_to_timestamp(raw, F.lit(p)) for p in ("d/M/yyyy H:mm:ss", "d/M/yyyy H:mm", "d/M/yyyy", "yyyy-MM-dd HH:mm:ss", "yyyy-MM-dd")))
    return df.select(F.trim("visita_id").alias("visita_id"), ts.alias("ts")).where("visita_id <> '' and ts is not null")


def damage_graph(nodes: DataFrame, edges: DataFrame) -> dict[str, DataFrame]:
    """Tables of a knowledge graph: nodes (id, tipo, patron, doc, ref) and edges (de, a, relacion, peso).

    terms: (pattern, target, kind) of `detecta`; weights: the largest `indica` of each finding; critical: `pondera` of each
    element; severity: (pattern, weight) of terms whose target has a weight; cited: where a finding is described.
    """
    told = edges.where("relacion = 'detecta'").join(nodes.select(F.col("id").alias("de"), "patron"), "de").join(nodes.select(F.col("id").alias("a"), F.col("tipo").alias("kind")), "a")
    terms = told.where("coalesce(patron, '') <> ''").select(F.col("patron").alias("pattern"), F.col("a").alias("target"), "kind")
    weights = edges.where("relacion = 'indica'").groupBy(F.col("de").alias("target")).agg(F.max(F.coalesce("peso", F.lit(0.0))).alias("weight"))
    return {
        "terms": terms, "weights": weights, "critical": edges.where("relacion = 'pondera'").select(F.col("de").alias("target"), F.col("peso").alias("weight")), "severity": terms.join(weights, "target").select("pattern", "weight"),
        "cited": nodes.select(F.col("id").alias("target"), F.trim(F.concat_ws(" ", "doc", "ref")).alias("cita")),
    }


def file_visits(visits: DataFrame) -> DataFrame:
    """(file_id, visita_id) of linked evidence; the first visit (pos) has a file that several link to."""
    each = visits.select("pos", "visita_id", F.explode(text.file_ids(F.col("evidencia_soporte"))).alias("file_id"))
    return each.groupBy("file_id").agg(F.min(F.struct("pos", "visita_id")).alias("x")).select("file_id", "x.visita_id")


def settled_visits(sites: DataFrame, visits: DataFrame) -> DataFrame:
    """Visits whose coordinate is not to be taken from photos: those that have one from photos, and those whose running number
    names one site only."""
    once = sites.select(text.consecutive_key(F.col("consecutivo")).alias("k")).where("k <> ''").groupBy("k").count().where("count = 1").select("k")
    numbered = visits.select("visita_id", text.consecutive_key(F.col("consecutivo")).alias("k")).join(once, "k", "left_semi").select("visita_id")
    return visits.where("coords_fuente = 'exif'").select("visita_id").unionByName(numbered).distinct()


def stragglers(wanted: DataFrame, listed: DataFrame, most: int = 400) -> DataFrame:
    """The ids of linked files (file_id) that no listing holds, as many as may be looked up one by one; a file that is listed
    without a place is not one of them."""
    return wanted.select("file_id").distinct().join(listed.select("file_id").distinct(), "file_id", "left_anti").orderBy("file_id").limit(most)


def photos_of(files: DataFrame, links: DataFrame, visits: DataFrame, settled: DataFrame | None = None) -> DataFrame:
    """(visita_id, lat, lon) of photos with a usable place: by the file's id, or by a visit's id in its name."""
    usable = files.where("lat is not null and lon is not null and (abs(lat) > 1e-9 or abs(lon) > 1e-9)")
    by_id = usable.join(links, "file_id").select("visita_id", "lat", "lon", "file_id")
    # The words of a name are joined with the ids, so that names and visits don't all meet.
    words = usable.join(by_id.select("file_id"), "file_id", "left_anti").select("file_id", "lat", "lon", F.explode(F.array_distinct(F.split("name", r"[^A-Za-z0-9]+"))).alias("visita_id"))
    by_name = words.join(visits.select("visita_id").distinct(), "visita_id").select("visita_id", "lat", "lon", "file_id")
    out = by_id.unionByName(by_name)
    return (out if settled is None else out.join(settled, "visita_id", "left_anti")).select("visita_id", "lat", "lon")


def harvest_info(points: DataFrame, skipped: DataFrame) -> DataFrame:
    """One row: visits with photos, skipped ones, photos used and the median dispersion. points: what robust_centroid() gives."""
    a = points.agg(F.count(F.lit(1)).alias("visitas_con_gps"), F.coalesce(F.sum("n"), F.lit(0)).alias("fotos_gps_usadas"), F.round(F.percentile("spread_m", 0.5), 1).alias("dispersion_mediana_m"))
    return a.crossJoin(skipped.agg(F.count(F.lit(1)).alias("omitidas_por_confiables")))  # one row each


def geocode_targets(*tables: DataFrame) -> DataFrame:
    """(key, direccion) to ask a geocoder for: addresses of seven characters or more whose row has no place; one of each key, that
    of the first table (and row, by direccion_norm) that has it."""
    every = None
    for k, df in enumerate(tables):
        rows = df.where(parse_latlon(F.col("coords")).isNull()).select(F.trim("direccion_norm").alias("direccion"), F.lit(k).alias("_t"))
        rows = rows.where(~F.col("direccion").isin(*text.MISSING) & (F.length("direccion") >= 7)).withColumn("key", text.cache_key(F.col("direccion")))
        every = rows if every is None else every.unionByName(rows)
    return every.groupBy("key").agg(F.min(F.struct("_t", "direccion")).alias("x")).select("key", "x.direccion")


def geocode_pending(targets: DataFrame, cache: DataFrame, most: int | None = None) -> DataFrame:
    """The targets that the cache has no answer to; as many as may be asked, by key."""
    left = targets.join(cache.select("key"), "key", "left_anti")
    return left if most is None else left.orderBy("key").limit(most)


def geocode_accounts(targets: DataFrame, cache: DataFrame, answered: DataFrame) -> DataFrame:
    """One row of what a run did: answered holds (key, motivo), motivo empty where an answer was taken."""
    known = targets.join(cache.select("key", F.lit(True).alias("_c")).distinct(), "key", "left")
    a = known.agg(F.count(F.lit(1)).alias("intentadas"), F.count_if(F.coalesce("_c", F.lit(False))).alias("cache_hits"))
    b = answered.agg(F.count(F.lit(1)).alias("llamadas_api"), F.count_if(F.col("motivo") == "").alias("aceptadas_nuevas"), F.count_if(F.col("motivo") != "").alias("rechazadas_nuevas"))
    both = a.crossJoin(b)  # one row each
    return both.withColumn("omitidas_por_limite", F.col("intentadas") - F.col("cache_hits") - F.col("llamadas_api"))
