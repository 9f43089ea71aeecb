"""Inspections, surveys and zones against critical cases."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from siteweave.functions.coords import haversine_m
from siteweave.functions.similarity import difflib_ratio_from
from siteweave.functions.text import addr_key, global_id
from siteweave.operators.geo import near_join, nearest
from siteweave.shared import written

OUTSIDE = "(fuera de zona)"


def latest(df: DataFrame, key: str, ts: str, order: str) -> DataFrame:
    """The row of the newest time for each key; a missing time counts as oldest, the first row wins ties."""
    rank = F.row_number().over(Window.partitionBy(key).orderBy(F.desc(F.coalesce(F.col(ts).cast("double"), F.lit(-1.0))), order))
    return df.withColumn("_n", rank).where("_n = 1").drop("_n")


def pair_inspections(matches: DataFrame, inspections: DataFrame) -> DataFrame:
    """A row for each matched pair, each case without a match once, and each inspection that no case has (solo_f3).

    matches: (registro_id, edan_id, match_method); inspections: (edan_id).
    """
    hit = matches.where("edan_id is not null").select("registro_id", "edan_id", "match_method")
    rest = matches.groupBy("registro_id").agg(F.max(F.col("edan_id").isNotNull()).alias("any")).where("not any").select("registro_id", F.lit("").alias("edan_id"), F.lit("").alias("match_method"))
    alone = inspections.join(hit.select("edan_id").distinct(), "edan_id", "left_anti").select(F.lit("").alias("registro_id"), "edan_id", F.lit("solo_f3").alias("match_method"))
    return hit.unionByName(rest).unionByName(alone)


def done_records(pairs: DataFrame) -> DataFrame:
    """The cases that an inspection has reached, with the suffix of the pair taken off."""
    return pairs.where(~F.col("match_method").isin("", "solo_f3")).select(F.regexp_replace("registro_id", "-[^-]*$", "").alias("registro_id")).distinct()


def by_id_or_near(records: DataFrame, other: DataFrame, key: str, radius_m: float, available: bool = True) -> DataFrame:
    """For each record (key, origin, lat, lon): the other row (gid, rlat, rlon) of its global id, or else the nearest within
    the radius, how it was found and the distance in whole metres; found is null if the lookup was not available."""
    if not available:
        return records.select(key, F.lit(None).cast("string").alias("gid"), F.lit("").alias("via"), F.lit(None).cast("long").alias("dist"), F.lit(None).cast("boolean").alias("found"))
    ids = records.where(F.col("origin").startswith("arcgis:")).select(key, global_id(F.regexp_replace("origin", "^arcgis:", "")).alias("k"))
    exact = ids.join(other.select(global_id(F.col("gid")).alias("k"), "gid").dropDuplicates(["k"]), "k").select(key, F.col("gid").alias("x_gid"))
    met = nearest(records.select(key, "lat", "lon"), other, key, radius_m, "gid")
    near = met.select(key, F.col("gid").alias("n_gid"), F.round("dist_m").cast("long").alias("n_dist"))
    out = records.select(key).join(exact, key, "left").join(near, key, "left")
    via = F.when(F.col("x_gid").isNotNull(), "globalid").when(F.col("n_gid").isNotNull(), "cercania").otherwise("")
    return out.select(key, F.coalesce("x_gid", "n_gid").alias("gid"), via.alias("via"), F.when(F.col("x_gid").isNull(), F.col("n_dist")).alias("dist"), (via != "").alias("found"))


def by_address(records: DataFrame, other: DataFrame, key: str) -> DataFrame:
    """For each record (key, akey, lat, lon): the other row (pos, rkey, rlat, rlon) by address, in four grades: the same key;
    the first whose key begins the other's (8 characters each) within 150 m; the most similar key (0.90) with the same
    digits or within 150 m; the most similar (0.85) within 60 m.

    A better grade rules the others out, so each grade is looked for only where those before it gave nothing: equal keys by an equi
    join, beginnings among what lies within 150 m, and ratios for what is left. Beyond 150 m only the digits count, and then the first
    row of each key stands for all of its rows."""
    digits = lambda c: F.regexp_replace(c, r"\D+", " ")
    left = written(records.where("akey <> ''").select(key, "akey", "lat", "lon"), "keys")
    right = written(other.where("rkey <> ''").select("pos", "rkey", "rlat", "rlon"), "keys")
    firsts = right.groupBy("rkey").agg(F.min("pos").alias("pos"))
    told = lambda d, via: d.select(key, "pos", F.lit(via).alias("via"))
    equal = written(left.join(firsts, F.col("akey") == F.col("rkey")).groupBy(key).agg(F.min("pos").alias("pos")), "equal")
    rest = written(left.join(equal.select(key), key, "left_anti"), "rest")
    a, b = F.col("akey"), F.col("rkey")
    prefix = (F.length(a) >= 8) & (F.length(b) >= 8) & (a.startswith(b) | b.startswith(a))
    least = F.when(F.col("dist_m") <= 60, 0.85).otherwise(0.90)
    alike = 2.0 * F.least(F.length(a), F.length(b)) / (F.length(a) + F.length(b)) >= least
    near = near_join(rest, right, 150.0).select(key, "akey", "pos", "rkey", "dist_m", prefix.alias("prefix")).where(F.col("prefix") | alike)
    near = written(near, "near")
    begun = written(near.where("prefix").groupBy(key).agg(F.min("pos").alias("pos")), "begun")
    far = rest.select(key, "akey", digits(a).alias("d")).join(firsts.withColumn("d", digits(b)), "d").select(key, "akey", "pos", "rkey", F.lit(None).cast("double").alias("dist_m"))
    pairs = near.drop("prefix").unionByName(far).join(begun.select(key), key, "left_anti").withColumn("least", least)
    pairs = written(pairs.where(alike), "pairs")
    ratios = pairs.groupBy("akey", "rkey").agg(F.min("least").alias("least")).withColumn("ratio", difflib_ratio_from(a, b, F.col("least"))).where("ratio >= least").select("akey", "rkey", "ratio")
    rated = pairs.join(ratios, ["akey", "rkey"]).where("ratio >= least")
    grade = F.when(F.col("ratio") >= 0.90, 2).otherwise(3)
    order = Window.partitionBy(key).orderBy("grade", F.desc("ratio"), "pos")
    best = rated.withColumn("grade", grade).withColumn("_n", F.row_number().over(order)).where("_n = 1")
    return told(equal, "direccion").unionByName(told(begun, "combinado")).unionByName(best.select(key, "pos", F.when(F.col("grade") == 3, "combinado").otherwise("direccion").alias("via")))


def address_key(c: Column) -> Column:
    return addr_key(c)


def zone_rollup(zones: DataFrame, records: DataFrame) -> DataFrame:
    """Counts for each zone (zona_id), zones without records too, and for what lies outside all of them; most missing first.

    records: (zona_id, hecho). Blank and unknown zones count as outside, a row that is there only if it has records.
    """
    known = records.join(zones.select("zona_id", F.lit(True).alias("k")), "zona_id", "left")
    zone = F.when(F.col("k"), F.col("zona_id")).otherwise(OUTSIDE)
    counts = known.groupBy(zone.alias("zona_id")).agg(F.count(F.lit(1)).alias("n_total"), F.count_if("hecho").alias("n_hechos"))
    every = zones.select("zona_id").unionByName(counts.where(F.col("zona_id") == OUTSIDE).select("zona_id"))
    out = every.join(counts, "zona_id", "left").na.fill(0, ["n_total", "n_hechos"])
    return out.withColumn("n_faltantes", F.col("n_total") - F.col("n_hechos")).orderBy(F.desc("n_faltantes"), "zona_id")


def three_sources(pairs: DataFrame) -> DataFrame:
    """Inspections that a record with all three ids reaches, and those records in order, joined by '; '."""
    full = pairs.where("coalesce(sitio_id, '') <> '' and coalesce(visita_id, '') <> '' and coalesce(edan_id, '') <> '' and match_method not in ('', 'solo_f3')")
    return full.groupBy("edan_id").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("pos", "registro_id"))), lambda x: x["registro_id"]), "; ").alias("registros"))
