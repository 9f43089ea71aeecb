"""Queries for coordinates, roll-ups, cross-matches, rosters, text analysis and media, over the star-schema tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from siteweave.functions import coords, similarity, text
from siteweave.operators import calibrated, crossmatch, geo, linkage, media, metrics, triage
from siteweave.plans.linkage import _PRE, both, with_embeddings
from siteweave.shared import written
from siteweave.sources import images, readers, sinks
from siteweave.sources.tables import SITES, VISITS, sites, visits

QUERIES, SQL = {}, {}


def query(sql: str | None = None):
    def keep(f):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return keep


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


_HAV = "2 * 6371000.0::DOUBLE * asin(sqrt(pow(sin(radians({c} - {a}) / 2), 2) + cos(radians({a})) * cos(radians({c})) * pow(sin(radians({d} - {b}) / 2), 2)))"


@query("SELECT c_custkey AS id, CASE WHEN c_custkey % 6 = 5 THEN NULL ELSE round(3 + (c_custkey % 900) / 1000.0::DOUBLE, 9) END AS lat, CASE WHEN c_custkey % 6 = 5 THEN NULL ELSE round(-(76 + (c_custkey % 700) / 1000.0::DOUBLE), 9) END AS lon FROM customer")
def parsed_coordinates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Five notations of one point, and junk."""
    a, b = "format_string('%.3f', 3 + c_custkey % 900 / 1000D)", "format_string('%.3f', 76 + c_custkey % 700 / 1000D)"
    raw = f"CASE c_custkey % 6 WHEN 0 THEN concat({a}, ', -', {b}) WHEN 1 THEN concat('https://x/?q=', {a}, ',-', {b}) WHEN 2 THEN concat('-', {b}, '  ', {a}) WHEN 3 THEN concat(replace({a}, '.', ','), ', -', replace({b}, '.', ',')) WHEN 4 THEN concat('maps/@', {a}, ',-', {b}, ',17z') ELSE 'sin dato' END"
    p = coords.parse_coords(F.expr(raw))
    return table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("id"), F.round(p["lat"], 9).alias("lat"), F.round(p["lon"], 9).alias("lon"))


@query(f"SELECT a.sitio_id AS a, b.sitio_id AS b, round({_HAV.format(a='a.lat', b='a.lon', c='b.lat', d='b.lon')}, 3) AS m FROM ({SITES}) a JOIN ({SITES}) b ON a.pos < b.pos AND abs(a.lat - b.lat) < 0.001 AND abs(a.lon - b.lon) < 0.001 WHERE {_HAV.format(a='a.lat', b='a.lon', c='b.lat', d='b.lon')} <= 90")
def close_sites(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = sites(spark, sf_dir)
    right = s.select(F.col("pos").alias("rpos"), F.col("sitio_id").alias("b"), F.col("lat").alias("rlat"), F.col("lon").alias("rlon"))
    return geo.near_join(s.select("pos", F.col("sitio_id").alias("a"), "lat", "lon"), right, 90.0).where("pos < rpos").select("a", "b", F.round("dist_m", 3).alias("m"))


_SPOT = "SELECT c_custkey AS id, 3.45 + (c_custkey * 7919 % 20011) / 20011.0::DOUBLE * 0.0006 AS lat, -76.53 + (c_custkey * 104729 % 19997) / 19997.0::DOUBLE * 0.0006 AS lon FROM customer"


@query(f"WITH c AS ({_SPOT}), p AS (SELECT a.id, {_HAV.format(a='a.lat', b='a.lon', c='b.lat', d='b.lon')} AS m FROM c a JOIN c b ON a.id % 2 = 0 AND b.id % 2 = 1) SELECT id, near_rank, round(m, 3) AS m FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY m) AS near_rank FROM p WHERE m <= 90) WHERE near_rank <= 3")
def crowded_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All customers within one radius: the three nearest of the odd ones to each of the even ones."""
    k = F.col("c_custkey")
    c = table(spark, sf_dir, "customer").select(k.alias("id"), (3.45 + (k * 7919 % 20011) / 20011.0 * 0.0006).alias("lat"), (-76.53 + (k * 104729 % 19997) / 19997.0 * 0.0006).alias("lon"))
    right = c.where("id % 2 = 1").select(F.col("id").alias("other"), F.col("lat").alias("rlat"), F.col("lon").alias("rlon"))
    return geo.nearest(c.where("id % 2 = 0"), right, "id", 90.0, "other", 3).select("id", "near_rank", F.round("dist_m", 3).alias("m"))


@query("SELECT user_id, event_id, event_type FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY epoch_us(ts) DESC, event_id) AS n FROM events) WHERE n = 1")
def latest_event(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events").withColumn("t", F.unix_micros(F.col("ts").cast("timestamp")))
    return crossmatch.latest(e, "user_id", "t", "event_id").select("user_id", "event_id", "event_type")


@query("SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events")
def event_properties(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select("event_id", F.from_json("props", "k long")["k"].alias("k"))


@query("SELECT o_orderkey, CAST(CAST(o_orderdate - INTERVAL 5 HOUR AS DATE) AS VARCHAR) AS fecha FROM orders")
def local_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    ms = F.unix_millis(F.col("o_orderdate").cast("timestamp"))
    return table(spark, sf_dir, "orders").select("o_orderkey", readers.local_date(ms).cast("string").alias("fecha"))


_SCORE = """WITH r AS (SELECT o_orderkey AS k, o_totalprice, CAST(o_orderkey % 977 AS DOUBLE) AS age, o_orderkey % 5 = 0 AS visited, CASE WHEN 3 * (o_orderkey % 2) + 2 * (o_orderkey % 3) + o_orderkey % 4 > 0 THEN 1 - pow(0.6::DOUBLE, 3 * (o_orderkey % 2) + 2 * (o_orderkey % 3) + o_orderkey % 4) ELSE 0.0::DOUBLE END AS vict FROM orders),
 s AS (SELECT *, min(age) FILTER (WHERE NOT visited) OVER () AS lo, max(age) FILTER (WHERE NOT visited) OVER () AS hi FROM r),
 t AS (SELECT concat('R', k) AS registro_id, age, visited, round(30 * CAST(k % 10 AS DOUBLE) / 10 + 25 * vict + 10 * CASE k % 3 WHEN 0 THEN 1.0::DOUBLE WHEN 1 THEN 0.6::DOUBLE ELSE 0.0::DOUBLE END + 10 * CASE WHEN k % 7 = 0 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END + 5 * CASE k % 4 WHEN 1 THEN 1.0::DOUBLE WHEN 2 THEN 0.5::DOUBLE ELSE 0.0::DOUBLE END + 20 * CASE WHEN visited THEN 0.0::DOUBLE ELSE coalesce((age - lo) / nullif(hi - lo, 0), 0) END, 1) AS score FROM s)
SELECT registro_id, score, visited, CASE WHEN NOT visited THEN CAST(row_number() OVER (PARTITION BY visited ORDER BY score DESC, age DESC, registro_id) AS INT) ELSE 0 END AS prioridad FROM t"""


@query(_SCORE)
def visit_roster(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    k = F.col("o_orderkey")
    rows = o.select(
        F.concat(F.lit("R"), k).alias("registro_id"), ((k % 10).cast("double") / 10).alias("severity"), (k % 2).alias("dead"), (k % 3).alias("trapped"), (k % 4).alias("rescued"), (k % 977).cast("double").alias("age_days"),
        F.when(k % 3 == 0, "Riesgo ALTO").when(k % 3 == 1, "medio").otherwise("").alias("risk"), F.when(k % 7 == 0, "Sí").otherwise("no").alias("demolition"), F.when(k % 4 == 1, "1").when(k % 4 == 2, "2").otherwise("").alias("wave"), (k % 5 == 0).alias("visited"),
    )
    return triage.roster(rows).na.fill(0, ["prioridad"])


@query("""WITH z AS (SELECT n_nationkey AS zona FROM nation WHERE n_nationkey % 5 <> 0), r AS (SELECT CASE WHEN z.zona IS NULL THEN '(fuera de zona)' ELSE CAST(z.zona AS VARCHAR) END AS zona_id, c_acctbal > 0 AS hecho FROM customer LEFT JOIN z ON z.zona = c_nationkey),
 c AS (SELECT zona_id, count(*) AS n_total, count(*) FILTER (WHERE hecho) AS n_hechos FROM r GROUP BY zona_id), e AS (SELECT CAST(zona AS VARCHAR) AS zona_id FROM z UNION SELECT zona_id FROM c)
SELECT e.zona_id, coalesce(n_total, 0) AS n_total, coalesce(n_hechos, 0) AS n_hechos, coalesce(n_total, 0) - coalesce(n_hechos, 0) AS n_faltantes FROM e LEFT JOIN c USING (zona_id)""")
def zone_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    zones = table(spark, sf_dir, "nation").where("n_nationkey % 5 <> 0").select(F.col("n_nationkey").cast("string").alias("zona_id"))
    return crossmatch.zone_rollup(zones, table(spark, sf_dir, "customer").select(F.col("c_nationkey").cast("string").alias("zona_id"), (F.col("c_acctbal") > 0).alias("hecho")))


@query(f"""WITH s AS ({SITES}), v AS ({VISITS}), r AS (SELECT *, CASE WHEN vpos % 9 = 0 THEN concat('arcgis:{{', 's', true_pos, '}}') ELSE concat('app:', vpos) END AS origin FROM v),
 x AS (SELECT r.visita_id, s.sitio_id AS gid FROM r JOIN s ON r.origin LIKE 'arcgis:%' AND lower(s.sitio_id) = replace(replace(replace(r.origin, 'arcgis:', ''), '{{', ''), '}}', '')),
 n AS (SELECT r.visita_id, s.sitio_id AS gid, {_HAV.format(a='r.lat', b='r.lon', c='s.lat', d='s.lon')} AS d FROM r JOIN s ON abs(r.lat - s.lat) < 0.0005 AND abs(r.lon - s.lon) < 0.0005),
 n1 AS (SELECT * FROM n WHERE d <= 40 QUALIFY row_number() OVER (PARTITION BY visita_id ORDER BY d, gid) = 1)
SELECT v.visita_id, coalesce(x.gid, n1.gid) AS gid, CASE WHEN x.gid IS NOT NULL THEN 'globalid' WHEN n1.gid IS NOT NULL THEN 'cercania' ELSE '' END AS via, coalesce(CASE WHEN x.gid IS NULL THEN CAST(round(d) AS BIGINT) END, -1) AS dist, coalesce(x.gid, n1.gid) IS NOT NULL AS found FROM v LEFT JOIN x USING (visita_id) LEFT JOIN n1 USING (visita_id)""")
def inspection_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    v = visits(spark, sf_dir).select("visita_id", "lat", "lon", F.when(F.col("vpos") % 9 == 0, F.concat(F.lit("arcgis:{s"), "true_pos", F.lit("}"))).otherwise(F.concat(F.lit("app:"), "vpos")).alias("origin"))
    s = sites(spark, sf_dir).select(F.col("sitio_id").alias("gid"), F.col("lat").alias("rlat"), F.col("lon").alias("rlon"))
    return crossmatch.by_id_or_near(v, s, "visita_id", 40.0).na.fill(-1, ["dist"])


@query()
def survey_by_address(spark: SparkSession, sf_dir: str) -> DataFrame:
    v = visits(spark, sf_dir).select("visita_id", crossmatch.address_key(F.col("direccion_norm")).alias("akey"), "lat", "lon")
    s = sites(spark, sf_dir).select("pos", crossmatch.address_key(F.col("direccion_norm")).alias("rkey"), F.col("lat").alias("rlat"), F.col("lon").alias("rlon"))
    return crossmatch.by_address(v, s, "visita_id")


@query("""WITH m AS (SELECT concat('R', o_orderkey) AS registro_id, CASE WHEN o_orderkey % 3 = 0 THEN concat('S', o_custkey) END AS edan_id, CASE WHEN o_orderkey % 3 = 0 THEN 'geo' END AS match_method FROM orders)
SELECT registro_id, coalesce(edan_id, '') AS edan_id, coalesce(match_method, '') AS match_method FROM m UNION ALL SELECT '', concat('S', c_custkey), 'solo_f3' FROM customer WHERE concat('S', c_custkey) NOT IN (SELECT edan_id FROM m WHERE edan_id IS NOT NULL)""")
def inspection_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    hit = F.col("o_orderkey") % 3 == 0
    m = table(spark, sf_dir, "orders").select(F.concat(F.lit("R"), "o_orderkey").alias("registro_id"), F.when(hit, F.concat(F.lit("S"), "o_custkey")).alias("edan_id"), F.when(hit, "geo").alias("match_method"))
    return crossmatch.pair_inspections(m, table(spark, sf_dir, "customer").select(F.concat(F.lit("S"), "c_custkey").alias("edan_id")))


@query("SELECT CAST(o_custkey AS VARCHAR) AS edan_id, string_agg(CAST(o_orderkey AS VARCHAR), '; ' ORDER BY o_orderkey) AS registros FROM orders WHERE o_orderstatus <> 'P' GROUP BY o_custkey")
def three_source_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("o_orderkey").cast("string")
    p = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("pos"), k.alias("registro_id"), k.alias("sitio_id"), F.when(F.col("o_orderstatus") != "P", k).alias("visita_id"), F.col("o_custkey").cast("string").alias("edan_id"), F.lit("geo").alias("match_method"))
    return crossmatch.three_sources(p)


#: Square zones on a lattice, as rings of (x, y), with a hole in the even ones.
def _zones(spark: SparkSession) -> DataFrame:
    square = lambda x, y, h: "array(" + ", ".join(f"struct({x} + {dx * h} AS x, {y} + {dy * h} AS y)" for dx, dy in ((-1, -1), (1, -1), (1, 1), (-1, 1))) + ")"
    cx, cy = "(-76.535003D + (id % 5) * 0.01D)", "(3.435003D + floor(id / 5) * 0.01D)"
    return spark.range(25).selectExpr("id AS pos", "concat('Z', id) AS zona_id", f"CASE WHEN id % 2 = 0 THEN array({square(cx, cy, 0.004)}, {square(cx, cy, 0.001)}) ELSE array({square(cx, cy, 0.004)}) END AS rings")


_ZONE_SQL = f"""WITH z AS (SELECT i AS pos, concat('Z', i) AS zona_id, -76.535003::DOUBLE + (i % 5) * 0.01::DOUBLE AS cx, 3.435003::DOUBLE + floor(i / 5) * 0.01::DOUBLE AS cy FROM range(25) t(i))
SELECT s.sitio_id, z.zona_id FROM ({SITES}) s JOIN z ON abs(s.lon - cx) < 0.004 AND abs(s.lat - cy) < 0.004 AND NOT (z.pos % 2 = 0 AND abs(s.lon - cx) < 0.001 AND abs(s.lat - cy) < 0.001)"""


@query(_ZONE_SQL)
def zone_of_site(spark: SparkSession, sf_dir: str) -> DataFrame:
    return geo.containing(sites(spark, sf_dir).select("sitio_id", "lat", "lon"), _zones(spark), "sitio_id", geo.covered).select("sitio_id", "zona_id")


@query(_ZONE_SQL.replace("AND NOT (z.pos % 2 = 0 AND abs(s.lon - cx) < 0.001 AND abs(s.lat - cy) < 0.001)", ""))
def zone_by_ray_casting(spark: SparkSession, sf_dir: str) -> DataFrame:
    return geo.containing(sites(spark, sf_dir).select("sitio_id", "lat", "lon"), _zones(spark), "sitio_id", lambda rings, x, y: geo.in_ring(rings[0], x, y)).select("sitio_id", "zona_id")


_PHOTOS = f"SELECT true_pos AS place, lat, lon + CASE WHEN vpos % 17 = 0 THEN 0.01::DOUBLE ELSE 0.0::DOUBLE END AS lon FROM ({VISITS}) WHERE lat IS NOT NULL"
_P2 = _HAV.format(a="p.lat", b="p.lon", c="c.clat", d="c.clon")


@query(f"""WITH p AS ({_PHOTOS}), m AS (SELECT place, median(lat) AS mlat, median(lon) AS mlon FROM p GROUP BY place), k AS (SELECT p.* FROM p JOIN m USING (place) WHERE {_HAV.format(a='p.lat', b='p.lon', c='m.mlat', d='m.mlon')} <= 75),
 c AS (SELECT place, avg(lat) AS clat, avg(lon) AS clon, count(*) AS n FROM k GROUP BY place), s AS (SELECT p.place, max({_P2}) AS spread FROM k p JOIN c USING (place) GROUP BY p.place)
SELECT m.place, coalesce(n, 1) AS n, round(coalesce(spread, 0), 1) AS spread_m FROM m LEFT JOIN c USING (place) LEFT JOIN s USING (place)""")
def photo_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = visits(spark, sf_dir).where("lat is not null").select(F.col("true_pos").alias("place"), "lat", (F.col("lon") + F.when(F.col("vpos") % 17 == 0, 0.01).otherwise(0.0)).alias("lon"))
    return geo.robust_centroid(p, "place").select("place", "n", "spread_m")


@query("SELECT l_orderkey AS folder, l_linenumber AS stem, CASE WHEN l_linenumber % 3 <> 2 THEN 'exif' WHEN bool_or(l_linenumber % 3 <> 2 AND l_linenumber % 2 = 0) OVER w THEN 'carpeta' ELSE 'sin_gps' END AS fuente FROM (SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem) WINDOW w AS (PARTITION BY l_orderkey)")
def drone_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = F.col("l_linenumber")
    has = n % 3 != 2
    f = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber").distinct().select(F.col("l_orderkey").alias("folder"), n.cast("string").alias("stem"), F.when(n % 2 == 0, "JPG").otherwise("MP4").alias("ext"), F.when(has, 3.0 + n / 100.0).alias("lat"), F.when(has, -76.0 - n / 100.0).alias("lon"))
    return media.file_coordinates(f).select("folder", F.col("stem").cast("int").alias("stem"), "fuente")


@query("SELECT c_custkey AS id, CASE WHEN c_custkey % 11 = 0 THEN NULL ELSE round((CASE WHEN c_custkey % 3 = 0 THEN -1 ELSE 1 END) * (c_custkey % 90 + (c_custkey % 60) / 60.0::DOUBLE + (c_custkey % 5999) / 100.0::DOUBLE / 3600), 9) END AS lat, CASE WHEN c_custkey % 11 = 0 THEN NULL ELSE round(0 - (c_custkey % 179 + (c_custkey % 59) / 60.0::DOUBLE), 9) END AS lon FROM customer")
def image_positions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The bytes of a photograph for each customer, and the position read from them; every eleventh is cut short."""
    k = F.col("c_custkey")
    word = lambda c, n=8: F.lpad(F.hex(c.cast("long")), n, "0")
    one = word(F.lit(1))
    head = F.lit("FFD8FFE100884578696600004D4D002A00000008000188250004000000010000001A00000000")
    entries = F.concat(F.lit("0004" + "0001000200000002"), F.when(k % 3 == 0, "53000000").otherwise("4E000000"), F.lit("000200050000000300000050" + "00030002000000025700" + "0000" + "000400050000000300000068" + "00000000"))
    lat = F.concat(word(k % 90), one, word(k % 60), one, word(k % 5999), word(F.lit(100)))
    lon = F.concat(word(k % 179), one, word(k % 59), one, word(F.lit(0)), one)
    whole = F.concat(head, entries, lat, lon, F.lit("FFD9"))
    content = F.unhex(F.when(k % 11 == 0, F.substring(whole, 1, 200)).otherwise(whole))
    return table(spark, sf_dir, "customer").select(k.alias("id"), images.position(content).alias("p")).select("id", F.round("p.lat", 9).alias("lat"), F.round("p.lon", 9).alias("lon"))


def _flights(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files of an order each: two of three with their own position."""
    n = F.col("l_linenumber")
    f = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber").distinct()
    own = n % 3 != 2
    return f.select((F.col("l_orderkey") % 10).alias("flight"), F.col("l_orderkey").cast("string").alias("place"), F.when(own, "exif").otherwise("sin_gps").alias("fuente"), F.when(own, F.lit(3.4)).alias("lat"), F.when(own, F.lit(-76.5)).alias("lon"))


_FLIGHTS = "f AS (SELECT DISTINCT l_orderkey % 10 AS flight, CAST(l_orderkey AS VARCHAR) AS place, l_linenumber, l_linenumber % 3 <> 2 AS own FROM lineitem)"


@query(f"WITH {_FLIGHTS} SELECT flight, place, count(*) AS n, count_if(own) AS n_gps FROM f GROUP BY ALL")
def flight_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return media.folder_counts(_flights(spark, sf_dir))


@query(f"WITH {_FLIGHTS} SELECT CASE WHEN own THEN 'exif' ELSE 'sin_gps' END AS fuente, count(*) AS n, count_if(own) AS n_gps, round(100.0::DOUBLE * count(*) / (SELECT count(*) FROM f), 1) AS pct FROM f GROUP BY own")
def flight_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return media.source_counts(_flights(spark, sf_dir))


@query(f"""WITH {_FLIGHTS}, p AS (SELECT flight, place, bool_or(own) AS own, CAST(place AS BIGINT) % 4 AS k FROM f GROUP BY flight, place)
SELECT flight, place, CASE WHEN k >= 2 OR (k = 1 AND NOT own) THEN 'geocode' WHEN own THEN 'fotos' ELSE '' END AS fuente, CASE WHEN k >= 2 THEN 3.402::DOUBLE WHEN k = 1 AND NOT own THEN 3.5::DOUBLE WHEN own THEN 3.4::DOUBLE END AS lat FROM p""")
def place_resolution(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Places by photographs and geocoder: a quarter unknown to the geocoder, a quarter 11 km off."""
    f, k = _flights(spark, sf_dir), F.col("o_orderkey") % 4
    answers = table(spark, sf_dir, "orders").where(k > 0).select((F.col("o_orderkey") % 10).alias("flight"), F.col("o_orderkey").cast("string").alias("place"), F.when(k == 1, 3.5).otherwise(3.402).alias("lat"), F.lit(-76.5).alias("lon"))
    return media.place_coordinates(f, answers).select("flight", "place", "fuente", F.round("lat", 9).alias("lat"))


@query(f"SELECT visita_id, CASE WHEN vpos % 4 = 0 THEN 'exif' ELSE coords_fuente END AS coords_fuente, CASE WHEN vpos % 4 = 0 THEN 3.41::DOUBLE ELSE round(lat, 9) END AS lat, CASE WHEN vpos % 4 = 0 THEN 0.0::DOUBLE END AS coords_precision_m, CASE WHEN vpos % 4 = 0 THEN 2 ELSE 0 END AS n_fotos FROM ({VISITS})")
def photographed_visits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every fourth visit has three photographs, one of them a kilometre off."""
    v = visits(spark, sf_dir)
    files = v.where("vpos % 4 = 0").select("visita_id", F.explode(F.array(F.lit(0.0), F.lit(0.0), F.lit(0.01))).alias("off")).select("visita_id", (3.41 + F.col("off")).alias("lat"), F.lit(-76.52).alias("lon"))
    return media.photo_points(files, v.select("visita_id", "lat", "lon", "coords_fuente")).select("visita_id", "coords_fuente", F.round("lat", 9).alias("lat"), "coords_precision_m", "n_fotos")


@query(f"SELECT visita_id, CASE WHEN lat IS NULL AND vpos % 3 = 0 THEN 'geocode' ELSE coords_fuente END AS coords_fuente, CASE WHEN lat IS NULL AND vpos % 3 = 0 THEN 3.42::DOUBLE ELSE round(lat, 9) END AS lat FROM ({VISITS})")
def geocoded_visits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Visits without a place from the geocoder's cache; a third of them are in it with one, a third without."""
    v = visits(spark, sf_dir)
    cache = v.where("vpos % 3 < 2").select(F.col("visita_id").alias("key"), F.when(F.col("vpos") % 3 == 0, 3.42).alias("lat"), F.lit(-76.52).alias("lon"), F.lit(15.0).alias("precision_m"))
    return media.fill_from_cache(v.select("visita_id", "lat", "lon", "coords_fuente"), cache, "visita_id").select("visita_id", "coords_fuente", F.round("lat", 9).alias("lat"))


@query(f"SELECT DISTINCT CAST(floor(lat / 0.01::DOUBLE) AS BIGINT) AS cy, CAST(floor(lon / 0.01::DOUBLE) AS BIGINT) AS cx, round(floor(lat / 0.01::DOUBLE) * 0.01::DOUBLE - 0.0025::DOUBLE, 6) AS lat_min, round((floor(lon / 0.01::DOUBLE) + 1) * 0.01::DOUBLE + 0.0025::DOUBLE, 6) AS lon_max FROM ({SITES}) WHERE lat IS NOT NULL")
def tiles_to_fetch(spark: SparkSession, sf_dir: str) -> DataFrame:
    return readers.occupied_tiles(sites(spark, sf_dir)).select("cy", "cx", F.round("lat_min", 6).alias("lat_min"), F.round("lon_max", 6).alias("lon_max"))


@query("SELECT l_partkey AS part, min(l_orderkey * 10 + l_linenumber) AS pos FROM lineitem GROUP BY l_partkey")
def features_once(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Features that several tiles hold: the parts of all orders by their geometry's text."""
    f = table(spark, sf_dir, "lineitem").select((F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("pos"), F.concat(F.lit("[[["), F.lpad(F.col("l_partkey").cast("string"), 12, "0")).alias("geometry"))
    return readers.distinct_features(f).select(F.substring("geometry", 4, 12).cast("long").alias("part"), "pos")


@query("SELECT c_custkey AS id, CASE c_custkey % 5 WHEN 3 THEN NULL WHEN 4 THEN NULL ELSE round(3 + (c_custkey % 900) / 1000.0::DOUBLE, 9) END AS lat, CASE c_custkey % 5 WHEN 3 THEN NULL WHEN 4 THEN NULL ELSE round(CASE c_custkey % 5 WHEN 2 THEN -(176 + (c_custkey % 4)) ELSE -(76 + (c_custkey % 4)) END - 0.5::DOUBLE, 9) END AS lon FROM customer")
def subtitle_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Subtitle files of drones: labelled, with the longitude first, in the other order, at the null island, and without a point."""
    k = F.col("c_custkey")
    lat = F.format_string("%.3f", 3 + (k % 900) / 1000.0)
    lon = lambda d: F.format_string("-%d.5", d + k % 4)
    told = F.when(k % 5 == 0, F.concat(F.lit("1\n00:00 --> 00:01\n[latitude: "), lat, F.lit("] [longitude: "), lon(76), F.lit("] [rel_alt: 1.5]"))).when(k % 5 == 1, F.concat(F.lit("GPS("), lon(76), F.lit(","), lat, F.lit(",19)")))
    told = told.when(k % 5 == 2, F.concat(F.lit("GPS ( "), lat, F.lit(", "), lon(176), F.lit(", 19)"))).when(k % 5 == 3, "latitude: 0.000 longitude: 0.000").otherwise("HOME")
    return table(spark, sf_dir, "customer").select(k.alias("id"), coords.srt_point(told).alias("p")).select("id", F.round("p.lat", 9).alias("lat"), F.round("p.lon", 9).alias("lon"))


@query("SELECT c_custkey AS key, CASE c_custkey % 4 WHEN 0 THEN 15.0::DOUBLE WHEN 1 THEN 40.0::DOUBLE END AS precision_m, CASE c_custkey % 4 WHEN 2 THEN 'imprecisa' WHEN 3 THEN 'sin_resultados' ELSE '' END AS motivo FROM customer")
def geocode_acceptance(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("c_custkey")
    kind = F.when(k % 4 == 0, "ROOFTOP").when(k % 4 == 1, "RANGE_INTERPOLATED").when(k % 4 == 2, "GEOMETRIC_CENTER")
    a = table(spark, sf_dir, "customer").select(k.alias("key"), kind.alias("location_type"), F.lit(3.4).alias("lat"), F.lit(-76.5).alias("lon"))
    return media.accept_geocode(a).select("key", "precision_m", "motivo")


@query("SELECT user_id AS key, max(event_id) FILTER (WHERE n = 1) AS event_id FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, CASE WHEN event_type = 'click' THEN 0 ELSE 1 END, event_id) AS n FROM events) GROUP BY user_id")
def geocode_cache_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events").select(F.col("user_id").alias("key"), "ts", "event_id", "event_type")
    one = lambda d: crossmatch.latest(d.withColumn("t", F.unix_micros(F.col("ts").cast("timestamp"))), "key", "t", "event_id").drop("t", "event_type")
    return media.merge_cache(one(e.where("event_type = 'click'")), one(e.where("event_type <> 'click'"))).select("key", "event_id")


_FILES = "https://drive.example/file/d/"


@query(f"SELECT page_id, list_extract(regexp_extract_all(concat('{_FILES}', md5(url), '/view'), '/d/([A-Za-z0-9_-]{{20,}})', 1), 1) AS file_id, 1 AS n FROM pages")
def linked_file_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    ids = text.file_ids(F.concat(F.lit(_FILES), F.md5("url"), F.lit("/view")))
    return table(spark, sf_dir, "pages").select("page_id", F.get(ids, F.lit(0)).alias("file_id"), F.size(ids).alias("n"))


@query("SELECT doc_id, count(*) FILTER (WHERE trim(s) <> '') AS n FROM (SELECT doc_id, unnest(regexp_split_to_array(coalesce(text, ''), '[.;\\n]+')) AS s FROM documents) GROUP BY doc_id")
def sentence_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = F.split(F.coalesce("text", F.lit("")), r"[.;\n]+")
    return table(spark, sf_dir, "documents").groupBy("doc_id").agg(F.sum(F.size(F.filter(parts, lambda s: F.trim(s) != ""))).alias("n"))


TERMS = [("there?", "grieta_generica", "patologia"), ("tha", "fisura_generica", "patologia"), ("erst", "grieta_diagonal", "patologia"), ("hea", "muro_carga", "elemento"), ("ing", "columna", "elemento")]
WEIGHT, CRITICAL = {"grieta_generica": 0.25, "fisura_generica": 0.25, "grieta_diagonal": 0.7}, {"muro_carga": 0.8, "columna": 1.0}
# Findings that give way to more special ones of the same sentence.
SUPERSEDE = {"grieta_generica": ("grieta_diagonal", "grieta_horizontal_flexion"), "fisura_generica": ("grieta_diagonal", "grieta_horizontal_flexion", "grieta_generica"), "perdida_recubrimiento": ("acero_expuesto",)}


@query()
def text_damage(spark: SparkSession, sf_dir: str) -> DataFrame:
    return triage.analyse(table(spark, sf_dir, "documents").select("doc_id", "text"), "doc_id", "text", TERMS, WEIGHT, CRITICAL, SUPERSEDE)


@query("SELECT doc_id, greatest(CASE WHEN regexp_matches(coalesce(text, ''), '(?i)thingst') THEN 0.9::DOUBLE ELSE 0.0::DOUBLE END, CASE WHEN regexp_matches(coalesce(text, ''), '(?i)bleing') THEN 0.25::DOUBLE ELSE 0.0::DOUBLE END) AS severity FROM documents")
def graph_severity(spark: SparkSession, sf_dir: str) -> DataFrame:
    terms = spark.createDataFrame([("thingst", 0.9), ("bleing", 0.25)], "pattern string, weight double")
    return triage.graph_severity(table(spark, sf_dir, "documents"), terms).select("doc_id", "severity")


@query("WITH b AS (SELECT o_orderkey AS k, CASE WHEN o_orderkey % 11 = 0 THEN 100.0::DOUBLE ELSE least(100.0::DOUBLE, round_even(CAST(o_orderkey % 60 + 15 * (o_orderkey % 10) / 10.0::DOUBLE AS DOUBLE), 0) + 30) END AS base, o_orderkey % 2 = 0 AS mention FROM orders) SELECT k, base, CASE WHEN base >= 100 THEN 'inmediata' WHEN mention AND base >= 50 THEN 'prioritaria' WHEN NOT mention AND base >= 70 THEN 'probable' END AS categoria FROM b")
def demolition_classes(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("o_orderkey")
    base = triage.demolition_score(k % 11 == 0, (k % 60 + 30).cast("double"), (k % 10).cast("double") / 10)
    return table(spark, sf_dir, "orders").select(k.alias("k"), base.alias("base"), triage.demolition_class(k % 2 == 0, base).alias("categoria"))


@query("SELECT c_custkey, sha1(c_name) AS digest FROM customer")
def name_digests(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").select("c_custkey", F.sha1(F.col("c_name").cast("binary")).alias("digest"))


_SHA = "WITH RECURSIVE d AS (SELECT c_custkey, list_transform(string_split(sha1(c_name), ''), lambda h: CAST(instr('0123456789abcdef', h) - 1 AS INT)) AS n, '' AS o, 0 AS k FROM customer UNION ALL SELECT c_custkey, q.ds, substr('0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZ', q.r + 1, 1) || o, k + 1 FROM (SELECT c_custkey, o, k, list_reduce(list_transform(n, lambda x: {'ds': [x], 'r': x}), lambda s, x: {'ds': list_append(s.ds, CAST(floor((s.r * 16 + x.r) / 36) AS INT)), 'r': (s.r * 16 + x.r) % 36}, {'ds': CAST([] AS INT[]), 'r': 0}) AS q FROM d WHERE k < 31) t)"


@query(_SHA + " SELECT c_custkey, rpad(substr(ltrim(o, '0'), 1, 5), 5, '0') AS id_asignacion FROM d WHERE k = 31")
def short_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").select("c_custkey", triage.short_id(F.col("c_name")).alias("id_asignacion"))


_PAIRS = "(SELECT DISTINCT p_name AS a FROM part) x, (SELECT DISTINCT p_name AS b FROM part) y"


@query(f"SELECT a, b, round(jaro_winkler_similarity(a, b), 6) AS jw, round(1 - damerau_levenshtein(a, b) / CAST(greatest(length(a), length(b)) AS DOUBLE), 6) AS dl FROM {_PAIRS} WHERE substr(a, 1, 1) = substr(b, 1, 1)")
def name_similarity(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = table(spark, sf_dir, "part").select(F.col("p_name").alias("a"), F.substring("p_name", 1, 1).alias("i")).distinct()
    met = names.join(names.withColumnRenamed("a", "b"), "i")
    return met.select("a", "b", F.round(similarity.jaro_winkler_similarity("a", "b"), 6).alias("jw"), F.round(similarity.damerau_levenshtein_similarity("a", "b"), 6).alias("dl"))


@query()
def name_token_ratios(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = table(spark, sf_dir, "part").select(F.col("p_name").alias("a"), F.substring("p_name", 1, 1).alias("i")).distinct()
    met = names.join(names.withColumnRenamed("a", "b"), "i")
    return met.select("a", "b", similarity.token_sort_ratio("a", "b").alias("sort"), similarity.token_set_ratio("a", "b").alias("set"), similarity.difflib_ratio("a", "b").alias("seq"))


@query(f"SELECT v.visita_id, s.pos, true AS hit FROM ({VISITS}) v JOIN ({SITES}) s ON {_HAV.format(a='v.lat', b='v.lon', c='s.lat', d='s.lon')} <= 200 AND abs(v.lat - s.lat) < 0.002 AND abs(v.lon - s.lon) < 0.002")
def geo_candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    v, e = both(spark, sf_dir)
    right = e.select("pos", F.col("lat").alias("rlat"), F.col("lon").alias("rlon"))
    return geo.near_join(v.select("visita_id", "lat", "lon"), right, 200.0).select("visita_id", "pos", F.lit(True).alias("hit"))


def _with_similar(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Visits and sites with embeddings, and each visit's ten nearest sites by them."""
    v, e = with_embeddings(spark, sf_dir, *both(spark, sf_dir))
    return v, e, written(linkage.nearest_embeddings(v, e, 10, addressed=False), "similar")


@query(f"""{_PRE}, m AS (SELECT CAST(vec_id AS BIGINT) AS id, min(embedding) AS x FROM embeddings WHERE vec_id IS NOT NULL GROUP BY 1), c AS (SELECT count(*) AS n FROM m),
 ve AS (SELECT k, x FROM (SELECT DISTINCT true_pos AS k FROM vh), c JOIN m ON m.id = k % c.n), ee AS (SELECT pos, x FROM eh, c JOIN m ON m.id = pos % c.n),
 t AS (SELECT k, pos FROM ve JOIN ee ON true QUALIFY row_number() OVER (PARTITION BY k ORDER BY list_cosine_similarity(CAST(ve.x AS DOUBLE[]), CAST(ee.x AS DOUBLE[])) DESC, pos) <= 10),
 p AS (SELECT visita_id, t.pos, 'emb' AS b FROM vh JOIN t ON t.k = vh.true_pos UNION ALL SELECT v.visita_id, e.pos, 'via' FROM vh v JOIN eh e ON floor(v.road) = floor(e.road) AND v.road <> 0
 UNION ALL SELECT v.visita_id, e.pos, 'barrio' FROM vh v JOIN eh e ON upper(trim(v.barrio)) = upper(trim(e.barrio)) AND length(trim(v.barrio)) > 3
 UNION ALL SELECT v.visita_id, e.pos, 'geo' FROM vh v JOIN eh e ON abs(v.lat - e.lat) < 0.002 AND abs(v.lon - e.lon) < 0.002 WHERE {_HAV.format(a='v.lat', b='v.lon', c='e.lat', d='e.lon')} <= 200)
SELECT blocks, count(*) AS n FROM (SELECT array_to_string(list_sort(list(b)), '+') AS blocks FROM p GROUP BY visita_id, pos) GROUP BY blocks""")
def block_corroboration(spark: SparkSession, sf_dir: str) -> DataFrame:
    v, e, similar = _with_similar(spark, sf_dir)
    return calibrated.corroboration(v, e, similar=similar)


@query()
def calibrated_matches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The calibrated model in full: four blocks, 13 features, 200 trees, 5 folds, floors and labels."""
    v, e, similar = _with_similar(spark, sf_dir)
    near_certain = linkage.cascade(v, e, tiers=("preregistro", "handshake", "vector", "vector_block")).where("match_method in ('handshake', 'vector', 'vector_block')")
    known = written(near_certain.join(e.select("sitio_id", "pos"), "sitio_id").select("visita_id", "pos"), "known")
    return calibrated.calibrated(v, e, similar, known).select("visita_id", "pos", "trust", "match_method", "p", F.array_join("blocks", "+").alias("blocks"))


@query(f"SELECT pos, nation FROM ({SITES}) WHERE NOT (lat IS NULL AND coalesce(trim(barrio), '') IN ('', '-'))")
def quality_sites(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = sites(spark, sf_dir)
    return metrics.quality_filter(s, ["lat", "barrio"], ["lat", "barrio"]).select("pos", "nation")


@query("SELECT c_custkey, CASE WHEN o.k IS NOT NULL THEN o.total ELSE c_acctbal END AS c_acctbal, o.n FROM customer LEFT JOIN (SELECT o_custkey AS k, round(sum(o_totalprice), 2) AS total, count(*) AS n FROM orders GROUP BY 1) o ON o.k = c_custkey")
def upserted_accounts(spark: SparkSession, sf_dir: str) -> DataFrame:
    new = table(spark, sf_dir, "orders").groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.round(F.sum("o_totalprice"), 2).alias("c_acctbal"), F.count(F.lit(1)).alias("n"))
    return sinks.upsert(table(spark, sf_dir, "customer").select("c_custkey", "c_acctbal"), new, "c_custkey")


@query("SELECT n_name, coalesce(sum(c), 0) AS n FROM (SELECT n_name, CASE WHEN c_custkey IS NULL THEN 0 ELSE 1 END AS c FROM nation LEFT JOIN customer ON c_nationkey = n_nationkey) GROUP BY n_name".replace("coalesce(sum(c), 0)", "CAST(coalesce(sum(c), 0) AS BIGINT)"))
def records_by_nation(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "customer").groupBy("c_nationkey").agg(F.count(F.lit(1)).alias("n"))
    return table(spark, sf_dir, "nation").join(c, F.col("n_nationkey") == F.col("c_nationkey"), "left").select("n_name", F.coalesce("n", F.lit(0).cast("long")).alias("n"))


@query(f"""WITH RECURSIVE r AS (SELECT vpos, visita_id, coalesce(length(direccion_norm), 0) AS n, CAST(sum(3 + length(visita_id) + length(coalesce(direccion_norm, '')) + length(CAST(vpos AS VARCHAR))) OVER (ORDER BY vpos ROWS UNBOUNDED PRECEDING) AS BIGINT) AS upto FROM ({VISITS})),
 c(chunk, before, upto) AS (SELECT CAST(0 AS BIGINT), CAST(0 AS BIGINT), (SELECT max(upto) FROM r WHERE upto <= 100000) UNION ALL SELECT chunk + 1, c.upto, (SELECT max(r.upto) FROM r WHERE r.upto <= c.upto + 100000) FROM c WHERE c.upto < (SELECT max(upto) FROM r))
SELECT visita_id, n, chunk FROM r JOIN c ON r.upto > c.before AND r.upto <= c.upto""")
def cell_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    v = visits(spark, sf_dir).select("vpos", "visita_id", F.coalesce("direccion_norm", F.lit("")).alias("d"))
    return sinks.chunks(v, "vpos", 100_000).select("visita_id", F.length("d").cast("long").alias("n"), "chunk")


@query()
def embedding_tier(spark: SparkSession, sf_dir: str) -> DataFrame:
    emb = table(spark, sf_dir, "embeddings").select("vec_id", F.col("embedding").alias("emb"))
    n = emb.agg(F.count(F.lit(1)).alias("n_emb"))
    v, e = both(spark, sf_dir)
    give = lambda d, k: d.crossJoin(F.broadcast(n)).withColumn("vec_id", F.col(k) % F.col("n_emb")).join(emb, "vec_id").drop("vec_id", "n_emb")
    return linkage.embedding(give(v, "true_pos"), give(e, "pos"))
