"""Coordinates of places and visits from photographs and addresses."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from siteweave.functions.coords import haversine_m
from siteweave.operators.geo import robust_centroid

#: Precision in metres of the geocoder's answers that are taken.
ACCEPTED = {"ROOFTOP": 15.0, "RANGE_INTERPOLATED": 40.0}


def photo_points(files: DataFrame, visits: DataFrame, key: str = "visita_id") -> DataFrame:
    """visits with the robust centroid of their photos (key, lat, lon in files) in place of what was typed, and its spread."""
    c = robust_centroid(files.where("lat is not null and lon is not null").select(key, "lat", "lon"), key).select(key, F.col("lat").alias("p_lat"), F.col("lon").alias("p_lon"), "spread_m", F.col("n").alias("n_fotos"))
    out = visits.join(c, key, "left")
    has = F.col("p_lat").isNotNull()
    rest = [x for x in visits.columns if x not in ("lat", "lon", "coords_fuente")]
    return out.select(*rest, F.coalesce("p_lat", "lat").alias("lat"), F.coalesce("p_lon", "lon").alias("lon"), F.when(has, "exif").otherwise(F.col("coords_fuente")).alias("coords_fuente"), F.when(has, F.col("spread_m")).alias("coords_precision_m"), F.coalesce("n_fotos", F.lit(0).cast("long")).alias("n_fotos"))


def file_coordinates(files: DataFrame) -> DataFrame:
    """A coordinate for each file (folder, stem, ext, lat, lon): its own, that of the subtitle file of the same name, or the
    mean of the folder's photos that have one; fuente says which."""
    f = files.withColumns({"stem_l": F.lower("stem"), "ext_l": F.lower("ext")})
    side = f.where("ext_l = 'srt' and lat is not null").groupBy("folder", "stem_l").agg(F.min(F.struct("lat", "lon")).alias("side"))
    mean = f.where("ext_l in ('jpg', 'jpeg') and lat is not null").groupBy("folder").agg(F.avg("lat").alias("m_lat"), F.avg("lon").alias("m_lon"))
    out = f.where("ext_l <> 'srt'").join(side, ["folder", "stem_l"], "left").join(mean, "folder", "left")
    fuente = F.when(F.col("lat").isNotNull(), "exif").when(F.col("side").isNotNull(), "srt").when(F.col("m_lat").isNotNull(), "carpeta").otherwise("sin_gps")
    return out.select("folder", "stem", "ext", F.coalesce("lat", "side.lat", "m_lat").alias("lat"), F.coalesce("lon", "side.lon", "m_lon").alias("lon"), fuente.alias("fuente")).orderBy("folder", "stem", "ext")


def place_coordinates(files: DataFrame, geocoded: DataFrame, drift_m: float = 500.0) -> DataFrame:
    """One coordinate for each place (flight, place): the geocoded address if it is no farther than drift_m from the photos'
    centroid or there is none, else the centroid, else nothing."""
    photos = files.where("fuente = 'exif'").groupBy("flight", "place").agg(F.avg("lat").alias("c_lat"), F.avg("lon").alias("c_lon"))
    out = files.select("flight", "place").distinct().join(photos, ["flight", "place"], "left").join(geocoded.select("flight", "place", F.col("lat").alias("g_lat"), F.col("lon").alias("g_lon")), ["flight", "place"], "left")
    d = haversine_m(F.col("c_lat"), F.col("c_lon"), F.col("g_lat"), F.col("g_lon"))
    use = F.col("g_lat").isNotNull() & (F.col("c_lat").isNull() | (d <= drift_m))
    return out.select("flight", "place", F.when(use, F.col("g_lat")).otherwise(F.col("c_lat")).alias("lat"), F.when(use, F.col("g_lon")).otherwise(F.col("c_lon")).alias("lon"), F.when(use, "geocode").when(F.col("c_lat").isNotNull(), "fotos").otherwise("").alias("fuente"))


def folder_counts(files: DataFrame) -> DataFrame:
    """Files (flight, place, fuente, lat) of each place of a flight, and how many have a coordinate."""
    return files.groupBy("flight", F.coalesce("place", F.lit("")).alias("place")).agg(F.count(F.lit(1)).alias("n"), F.count("lat").alias("n_gps"))


def source_counts(files: DataFrame) -> DataFrame:
    """Files and those with a coordinate by where it comes from, and their share of all files in percent."""
    by = files.groupBy("fuente").agg(F.count(F.lit(1)).alias("n"), F.count("lat").alias("n_gps"))
    every = by.agg(F.sum("n").alias("_all"))  # one row
    return by.crossJoin(every).select("fuente", "n", "n_gps", F.round(100.0 * F.col("n") / F.col("_all"), 1).alias("pct"))


def accept_geocode(answers: DataFrame) -> DataFrame:
    """Answers (key, location_type, lat, lon) with precision_m where one is taken, and why the others are not."""
    from siteweave.functions.coords import CITY, within

    precision = F.create_map(*(F.lit(x) for kv in ACCEPTED.items() for x in kv))
    p = F.try_element_at(precision, F.col("location_type"))
    inside = within(CITY, F.col("lat"), F.col("lon"))
    reason = F.when(F.col("location_type").isNull(), "sin_resultados").when(p.isNull(), "imprecisa").when(~F.coalesce(inside, F.lit(False)), "fuera_de_zona").otherwise("")
    return answers.select("key", F.when(reason == "", F.col("lat")).alias("lat"), F.when(reason == "", F.col("lon")).alias("lon"), F.when(reason == "", p).alias("precision_m"), reason.alias("motivo"))


def merge_cache(*parts: DataFrame) -> DataFrame:
    """Cached answers (key, ts, ...) of several folders: the newest of each key, the earlier folder on ties."""
    every = None
    for k, part in enumerate(parts):
        one = part.withColumn("_part", F.lit(k))
        every = one if every is None else every.unionByName(one)
    rank = F.row_number().over(Window.partitionBy("key").orderBy(F.desc("ts"), "_part"))
    return every.withColumn("_n", rank).where("_n = 1").drop("_n", "_part")


def fill_from_cache(records: DataFrame, cache: DataFrame, key: str) -> DataFrame:
    """records with the cached coordinate where they have none."""
    c = cache.where("lat is not null").select(F.col("key").alias(key), F.col("lat").alias("g_lat"), F.col("lon").alias("g_lon"), "precision_m")
    out = records.join(c, key, "left")
    fill = F.col("lat").isNull() & F.col("g_lat").isNotNull()
    rest = [x for x in records.columns if x not in ("lat", "lon", "coords_fuente")]
    return out.select(*rest, F.when(fill, F.col("g_lat")).otherwise(F.col("lat")).alias("lat"), F.when(fill, F.col("g_lon")).otherwise(F.col("lon")).alias("lon"), F.when(fill, "geocode").otherwise(F.col("coords_fuente")).alias("coords_fuente"))
