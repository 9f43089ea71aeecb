"""Linkage queries over sites and visits derived from the star schema, each with SQL that states the same by arithmetic."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siteweave.functions import text
from siteweave.operators import integrate, linkage, metrics
from siteweave.operators.linkage import prepare
from siteweave.shared import written
from siteweave.sources.tables import SITES, TYPED, VISITS, sites, view, visits

QUERIES, SQL = {}, {}


def query(sql: str | None = None):
    def keep(f):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return keep


def both(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Both sides with their keys, written: all tiers read them, and the address expressions are evaluated once."""
    return written(prepare(visits(spark, sf_dir, spread=True)), "visits"), written(prepare(sites(spark, sf_dir, spread=True)), "sites")


#: The same sites and visits with the keys that parsing their addresses must give, written as arithmetic.
_NUM = "CASE WHEN {k} % 5 = 0 THEN 0.01::DOUBLE ELSE 0.0::DOUBLE END"
_PRE = f"""WITH e0 AS ({SITES}), e AS (SELECT *, list_extract(['CL','KR','AV'], CAST(pos % 3 + 1 AS BIGINT)) AS code, pos % 40 + 1 AS rn, CASE WHEN pos % 5 = 0 THEN 'A' ELSE '' END AS letter,
  CAST(CAST((pos % 3 + 1) * 1000 + pos % 40 + 1 + {_NUM.format(k='pos')} AS FLOAT) AS DOUBLE) AS road, CAST(pos % 23 + 1 AS DOUBLE) AS cr, CAST(pos % 97 + 1 AS DOUBLE) AS plate FROM e0),
 v0 AS ({VISITS}), v1 AS (SELECT *, vpos % 8 IN (0, 1, 2, 6) AS full_, vpos % 8 = 3 AS corner_, true_pos AS k FROM v0),
 v AS (SELECT *, CASE WHEN full_ THEN list_extract(['CL','KR','AV'], CAST(k % 3 + 1 AS BIGINT)) WHEN corner_ THEN 'KR' END AS code, CASE WHEN full_ THEN k % 40 + 1 WHEN corner_ THEN k % 23 + 1 END AS rn, CASE WHEN k % 5 = 0 AND full_ THEN 'A' ELSE '' END AS letter,
  CASE WHEN full_ THEN CAST(CAST((k % 3 + 1) * 1000 + k % 40 + 1 + {_NUM.format(k='k')} AS FLOAT) AS DOUBLE) WHEN corner_ THEN CAST(2000 + k % 23 + 1 AS DOUBLE) ELSE 0.0::DOUBLE END AS road,
  CASE WHEN full_ THEN CAST(k % 23 + 1 AS DOUBLE) ELSE 0.0::DOUBLE END AS cr, CASE WHEN full_ THEN CAST(k % 97 + 1 + CASE WHEN vpos % 8 = 2 THEN vpos % 60 ELSE 0 END AS DOUBLE) ELSE 0.0::DOUBLE END AS plate FROM v1),
 eh AS (SELECT *, concat(code, rn, letter, '#', CAST(cr AS BIGINT), '-', CAST(plate AS BIGINT)) AS hs, list_sort([round(road % 1000, 2), cr]) AS ck FROM e),
 vh AS (SELECT *, CASE WHEN full_ THEN concat(code, rn, letter, '#', CAST(cr AS BIGINT), '-', CAST(plate AS BIGINT)) WHEN corner_ THEN concat('KR', rn) WHEN vpos % 8 = 4 THEN 'EDIFICIOSINNUMERO' ELSE '' END AS hs,
  CASE WHEN full_ THEN list_sort([round(road % 1000, 2), cr]) WHEN corner_ THEN list_sort([round(road % 1000, 2), round(k % 40 + 1 + {_NUM.format(k='k')}, 2)]) END AS ck FROM v)"""
_MISS = "coalesce(trim({c}), '') IN ('', '-')"
_OK = f"({_MISS.format(c='v.barrio')} OR {_MISS.format(c='e.barrio')} OR v.barrio = e.barrio)"
_HAV = "2 * 6371000.0::DOUBLE * asin(sqrt(pow(sin(radians(e.lat - v.lat) / 2), 2) + cos(radians(v.lat)) * cos(radians(e.lat)) * pow(sin(radians(e.lon - v.lon) / 2), 2)))"
_BOTH_G = "(v.coords_fuente = 'geocode' AND e.coords_fuente = 'geocode')"
_NUMS = "list_distinct(list_filter([CAST(floor({s}.road % 1000) AS BIGINT), CAST(floor({s}.cr) AS BIGINT)], lambda n: n <> 0))"
_LOOSE = f"(len({_NUMS.format(s='v')}) = 0 OR len({_NUMS.format(s='e')}) = 0 OR len(list_intersect({_NUMS.format(s='v')}, {_NUMS.format(s='e')})) > 0)"
#: Tier by tier: (number, method, SQL giving visita_id, sitio_id, score), at most one row for each visit.
_FIRST = "QUALIFY row_number() OVER (PARTITION BY v.visita_id ORDER BY {o}e.pos) = 1"
_CONS = "regexp_full_match({c}, '[1-9][0-9]{{0,4}}')"
_TIER_SQL = {
    "preregistro": f"SELECT v.visita_id, e.sitio_id, 100.0::DOUBLE AS score FROM vh v JOIN eh e ON e.consecutivo = v.consecutivo WHERE {_CONS.format(c='v.consecutivo')} AND e.consecutivo IN (SELECT consecutivo FROM eh GROUP BY consecutivo HAVING count(*) = 1) AND {_OK} {_FIRST.format(o='')}",
    "handshake": f"SELECT v.visita_id, e.sitio_id, 100.0::DOUBLE AS score FROM vh v JOIN (SELECT * FROM eh QUALIFY row_number() OVER (PARTITION BY hs ORDER BY pos) = 1) e ON e.hs = v.hs AND v.hs LIKE '%#%' {_FIRST.format(o='')}",
    "vector": f"SELECT v.visita_id, e.sitio_id, round(sqrt(pow(v.road - e.road, 2) + pow(v.cr - e.cr, 2) + pow(v.plate - e.plate, 2)), 4) AS score FROM vh v JOIN eh e ON floor(v.road) = floor(e.road) AND v.cr = e.cr AND v.plate = e.plate WHERE v.cr <> 0 AND sqrt(pow(v.road - e.road, 2) + pow(v.cr - e.cr, 2)) <= 0.05 {_FIRST.format(o='sqrt(pow(v.road - e.road, 2) + pow(v.cr - e.cr, 2)), ')}",
    "vector_block": f"SELECT v.visita_id, e.sitio_id, round(abs(v.plate - e.plate), 1) AS score FROM vh v JOIN eh e ON round(v.road, 2) = round(e.road, 2) AND v.cr = e.cr WHERE v.cr <> 0 AND abs(v.plate - e.plate) <= 40 AND {_OK} {_FIRST.format(o='abs(v.plate - e.plate), ')}",
    "corner": f"SELECT v.visita_id, e.sitio_id, 100.0::DOUBLE AS score FROM vh v JOIN eh e ON v.ck = e.ck WHERE {_OK} {_FIRST.format(o='')}",
    "geo": f"SELECT visita_id, sitio_id, round(d, 1) AS score FROM (SELECT *, row_number() OVER (PARTITION BY visita_id ORDER BY d, pos) AS m FROM (SELECT *, row_number() OVER (PARTITION BY visita_id ORDER BY d, pos) AS n FROM (SELECT v.visita_id, e.sitio_id, e.pos, {_HAV} AS d, {_BOTH_G} AS g, {_LOOSE} AS l FROM vh v JOIN eh e ON abs(v.lat - e.lat) < 0.001 AND abs(v.lon - e.lon) < 0.001) WHERE d <= 90) WHERE n <= 3 AND d <= 40 AND NOT g AND l) WHERE m = 1",
}


def _tier(name: str):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        v, e = both(spark, sf_dir)
        return dict(linkage.TIERS)[name](v, e)

    run.__name__ = f"tier_{name}"
    return run


for _name, _sql in _TIER_SQL.items():
    query(f"{_PRE} SELECT * FROM ({_sql})")(_tier(_name))
for _name in ("tfidf", "fuzzy", "spatial_bridge"):
    query()(_tier(_name))
SQL["tier_spatial_bridge"] = f"{_PRE} SELECT visita_id, sitio_id, round(d, 1) AS score FROM (SELECT v.visita_id, e.sitio_id, e.pos, {_HAV} AS d, {_OK} AS ok, {_LOOSE} AS l FROM vh v JOIN eh e ON abs(v.lat - e.lat) < 0.001 AND abs(v.lon - e.lon) < 0.001) WHERE d <= 22 AND ok AND l QUALIFY row_number() OVER (PARTITION BY visita_id ORDER BY d, pos) = 1"

#: The text tier, all pairs of texts that share a gram.
_CANON = {"e": "concat(code, ' ', rn, letter, ' # ', CAST(cr AS BIGINT), '-', CAST(plate AS BIGINT))", "v": "CASE WHEN full_ THEN concat(code, ' ', rn, letter, ' # ', CAST(cr AS BIGINT), '-', CAST(plate AS BIGINT)) WHEN corner_ THEN concat('KR ', rn, ' CON CL ', k % 40 + 1, CASE WHEN k % 5 = 0 THEN 'A' ELSE '' END) WHEN vpos % 8 = 4 THEN 'NUMERO' ELSE '' END"}
_TEXT = "concat(canon, CASE WHEN trim(coalesce(barrio, '')) IN ('', '-', 'nan') THEN '' ELSE concat(' ', upper(trim(barrio))) END)"
_NESTED = "(len({a}) = 0 OR len({b}) = 0 OR len(list_filter({a}, lambda n: NOT list_contains({b}, n))) = 0 OR len(list_filter({b}, lambda n: NOT list_contains({a}, n))) = 0)".format(a=_NUMS.format(s="v"), b=_NUMS.format(s="e"))
_WORDS = "SELECT t, ' ' || w || ' ' AS p FROM (SELECT t, unnest(regexp_split_to_array(lower(t), '\\s+')) AS w FROM {x}) WHERE w <> ''"
_GRAMS = "SELECT t, g, count(*) AS tf FROM (SELECT t, unnest(list_transform(range(1, CAST(greatest(0, length(p) - n + 1) AS BIGINT) + 1), lambda i: substr(p, CAST(i AS INT), CAST(n AS INT)))) AS g FROM ({w}), (VALUES (2), (3), (4)) AS s(n)) GROUP BY t, g"
SQL["tier_tfidf"] = f"""{_PRE}, ec AS (SELECT *, {_TEXT} AS t FROM (SELECT *, {_CANON['e']} AS canon FROM eh) WHERE canon <> ''), vc AS (SELECT *, {_TEXT} AS t FROM (SELECT *, {_CANON['v']} AS canon FROM vh) WHERE canon <> ''),
 et AS (SELECT t, count(*) AS n FROM ec GROUP BY t), vt AS (SELECT DISTINCT t FROM vc), eg AS ({_GRAMS.format(w=_WORDS.format(x='et'))}), vg AS ({_GRAMS.format(w=_WORDS.format(x='vt'))}),
 idf AS (SELECT g, ln((1 + (SELECT sum(n) FROM et)) / (1 + sum(n))) + 1 AS idf FROM eg JOIN et USING (t) GROUP BY g),
 ew AS (SELECT t, g, w / sqrt(sum(w * w) OVER (PARTITION BY t)) AS w FROM (SELECT t, g, tf * idf AS w FROM eg JOIN idf USING (g))), vw AS (SELECT t, g, w / sqrt(sum(w * w) OVER (PARTITION BY t)) AS w FROM (SELECT t, g, tf * idf AS w FROM vg JOIN idf USING (g))),
 s AS (SELECT vw.t AS a, ew.t AS b, sum(vw.w * ew.w) AS sim FROM vw JOIN ew USING (g) GROUP BY 1, 2 HAVING sum(vw.w * ew.w) >= 0.82),
 five AS (SELECT a, ec.pos, sim FROM s JOIN ec ON ec.t = s.b QUALIFY row_number() OVER (PARTITION BY a ORDER BY round(sim, 12) DESC, ec.pos) <= 5)
SELECT v.visita_id, e.sitio_id, round(sim, 3) AS score FROM vc v JOIN five ON five.a = v.t JOIN ec e ON e.pos = five.pos WHERE {_OK} AND {_NESTED} QUALIFY row_number() OVER (PARTITION BY v.visita_id ORDER BY round(sim, 12) DESC, e.pos) = 1"""


@query(f"{_PRE} SELECT sitio_id AS id, hs AS handshake, road, cr AS crossing, plate, concat(code, ' ', rn, letter, ' # ', CAST(cr AS BIGINT), '-', CAST(plate AS BIGINT)) AS canon FROM eh UNION ALL SELECT visita_id, hs, road, cr, plate, CASE WHEN full_ THEN concat(code, ' ', rn, letter, ' # ', CAST(cr AS BIGINT), '-', CAST(plate AS BIGINT)) WHEN corner_ THEN concat('KR ', rn, ' CON CL ', k % 40 + 1, CASE WHEN k % 5 = 0 THEN 'A' ELSE '' END) WHEN vpos % 8 = 4 THEN 'NUMERO' ELSE '' END FROM vh")
def address_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    v, e = both(spark, sf_dir)
    cols = lambda d, k: d.select(F.col(k).alias("id"), "handshake", F.col("vec.road").alias("road"), F.col("vec.cross").alias("crossing"), F.col("vec.plate").alias("plate"), "canon")
    return cols(e, "sitio_id").unionByName(cols(v, "visita_id"))


@query(f"SELECT id, expected AS direccion_norm FROM ({TYPED})")
def normalized_addresses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return view(spark, sf_dir, TYPED).select("id", text.normalize_address(F.col("raw")).alias("direccion_norm"))


_CASCADE = "found AS (" + " UNION ALL ".join(f"SELECT visita_id, sitio_id, '{n}' AS match_method, CAST(score AS DOUBLE) AS match_score, {k} AS tier FROM ({s})" for k, (n, s) in enumerate(_TIER_SQL.items())) + "), best AS (SELECT * FROM found QUALIFY row_number() OVER (PARTITION BY visita_id ORDER BY tier) = 1), m AS (SELECT v.visita_id, best.sitio_id, match_method, match_score FROM vh v LEFT JOIN best USING (visita_id))"
_TRUST = f"""b AS (SELECT m.*, round(least(greatest(CASE match_method WHEN 'preregistro' THEN 0.97 WHEN 'handshake' THEN 0.95 WHEN 'vector' THEN 0.93 WHEN 'vector_block' THEN 0.82 WHEN 'corner' THEN 0.82 WHEN 'geo' THEN 0.78 END::DOUBLE
 + CASE WHEN {_MISS.format(c='v.barrio')} OR {_MISS.format(c='e.barrio')} THEN 0.0 WHEN v.barrio = e.barrio THEN 0.03 ELSE -0.08 END::DOUBLE
 + CASE WHEN {_BOTH_G} THEN 0.0 WHEN {_HAV} <= 60 THEN 0.05 WHEN {_HAV} > 250 THEN -0.12 ELSE 0.0 END::DOUBLE
 + CASE WHEN match_method = 'geo' AND (v.coords_fuente = 'geocode' OR e.coords_fuente = 'geocode') THEN -0.05 ELSE 0.0 END::DOUBLE, 0.05::DOUBLE), 0.99::DOUBLE), 2) AS trust FROM m JOIN vh v USING (visita_id) LEFT JOIN eh e ON e.sitio_id = m.sitio_id),
 t AS (SELECT visita_id, CASE WHEN sitio_id IS NOT NULL THEN trust END AS trust, sitio_id, match_method, match_score FROM b),
 c AS (SELECT visita_id, CASE WHEN ok THEN sitio_id END AS sitio_id, CASE WHEN ok THEN match_method END AS match_method, CASE WHEN ok THEN match_score END AS match_score, CASE WHEN ok THEN trust END AS trust FROM (SELECT *, trust >= 0.70 OR match_method = 'preregistro' AS ok FROM t))"""
_GEO_KEY = f"""near AS (SELECT visita_id, sitio_id, pos, d, ok, g, w, lead(d) OVER p AS nxt, row_number() OVER p AS n FROM (SELECT v.visita_id, e.sitio_id, e.pos, {_HAV} AS d, {_OK} AS ok, {_BOTH_G} AS g,
  round(0.74::DOUBLE + CASE WHEN v.coords_fuente = 'exif' THEN 0.04 ELSE -0.02 END::DOUBLE + CASE WHEN v.coords_fuente = 'geocode' OR e.coords_fuente = 'geocode' THEN -0.05 ELSE 0.0 END::DOUBLE, 2) AS w
  FROM vh v JOIN c ON c.visita_id = v.visita_id AND c.sitio_id IS NULL JOIN eh e ON abs(v.lat - e.lat) < 0.0011 AND abs(v.lon - e.lon) < 0.0011) WHERE d <= 105 WINDOW p AS (PARTITION BY visita_id ORDER BY d, pos)),
 gk AS (SELECT visita_id, sitio_id AS gs, round(d, 1) AS gd, w AS gt FROM near WHERE n = 1 AND d <= 80 AND (nxt IS NULL OR nxt - d >= 25) AND NOT g AND ok AND w >= 0.70),
 final AS (SELECT c.visita_id, coalesce(c.sitio_id, gs) AS sitio_id, CASE WHEN c.sitio_id IS NULL THEN CASE WHEN gs IS NOT NULL THEN 'geo_key' END ELSE match_method END AS match_method, CASE WHEN c.sitio_id IS NULL THEN gd ELSE match_score END AS match_score, CASE WHEN c.sitio_id IS NULL THEN gt ELSE trust END AS trust FROM c LEFT JOIN gk USING (visita_id))"""


def matched(spark: SparkSession, sf_dir: str, last: bool = True) -> tuple[DataFrame, DataFrame, DataFrame]:
    v, e = both(spark, sf_dir)
    m = linkage.cutoff(linkage.trust(linkage.cascade(v, e, tiers=linkage.CHEAP), v, e))
    return (linkage.geo_key(written(m, "matches"), v, e) if last else m), v, e


def with_embeddings(spark: SparkSession, sf_dir: str, v: DataFrame, e: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Both sides with the column emb: a row of embeddings by the number of the site; null where there is none."""
    emb = spark.read.parquet(f"{sf_dir}/embeddings.parquet").where("vec_id is not null").groupBy(F.col("vec_id").cast("long").alias("vec_id")).agg(F.min("embedding").alias("emb"))
    n = emb.agg(F.count(F.lit(1)).alias("n_emb"))  # one row
    give = lambda d, k: d.crossJoin(F.broadcast(n)).withColumn("vec_id", F.expr(f"try_mod({k}, n_emb)")).join(emb, "vec_id", "left").drop("vec_id", "n_emb")
    return written(give(v, "true_pos"), "visits"), written(give(e, "pos"), "sites")


def fully_matched(spark: SparkSession, sf_dir: str, last: bool = True) -> tuple[DataFrame, DataFrame, DataFrame]:
    """As matched(), through all ten tiers and with the semantic part of the trust."""
    v, e = with_embeddings(spark, sf_dir, *both(spark, sf_dir))
    m = linkage.cutoff(linkage.trust(linkage.cascade(v, e), v, e, semantic=True))
    return (linkage.geo_key(written(m, "matches"), v, e) if last else m), v, e


@query(f"{_PRE}, {_CASCADE} SELECT * FROM m")
def cascade_matches(spark: SparkSession, sf_dir: str) -> DataFrame:
    return linkage.cascade(*both(spark, sf_dir), tiers=linkage.CHEAP)


@query(f"{_PRE}, {_CASCADE}, {_TRUST} SELECT * FROM c")
def trusted_matches(spark: SparkSession, sf_dir: str) -> DataFrame:
    return matched(spark, sf_dir, last=False)[0]


@query(f"{_PRE}, {_CASCADE}, {_TRUST}, {_GEO_KEY} SELECT * FROM final")
def geo_key_matches(spark: SparkSession, sf_dir: str) -> DataFrame:
    return matched(spark, sf_dir)[0]


_MASTER = """r AS (SELECT concat(coalesce(e.sitio_id, '----'), '-', coalesce(v.visita_id, '----')) AS registro_id, CASE WHEN e.sitio_id IS NOT NULL AND v.visita_id IS NOT NULL THEN 'edan+visita' WHEN e.sitio_id IS NOT NULL THEN 'solo_edan' ELSE 'solo_visita' END AS fuente,
 e.sitio_id, v.visita_id, f.match_method, CASE WHEN coalesce(trim(e.direccion_norm), '') IN ('', '-') THEN v.direccion_norm ELSE e.direccion_norm END AS direccion_unificada, CASE WHEN coalesce(trim(e.barrio), '') IN ('', '-') THEN v.barrio ELSE e.barrio END AS barrio_unificado,
 CASE WHEN v.lat IS NOT NULL AND v.coords_fuente = 'exif' THEN 1 WHEN e.lat IS NOT NULL AND e.coords_fuente = 'exif' THEN 2 WHEN e.lat IS NOT NULL AND e.coords_fuente <> 'geocode' THEN 3 WHEN v.lat IS NOT NULL AND v.coords_fuente <> 'geocode' THEN 4 WHEN e.lat IS NOT NULL THEN 5 WHEN v.lat IS NOT NULL THEN 6 END AS rk,
 e.lat AS elat, e.lon AS elon, v.lat AS vlat, v.lon AS vlon, e.coords_fuente AS ef, v.coords_fuente AS vf, CAST(greatest(e.n_fallecidos, v.n_fallecidos) AS DOUBLE) AS n_fallecidos_total, f.trust, coalesce(e.road, v.road) AS road1
 FROM eh e FULL OUTER JOIN final f ON f.sitio_id = e.sitio_id FULL OUTER JOIN vh v ON v.visita_id = f.visita_id),
 i AS (SELECT registro_id, fuente, sitio_id, visita_id, match_method, direccion_unificada, barrio_unificado, CASE WHEN rk IN (1, 4, 6) THEN vlat ELSE elat END AS lat, CASE WHEN rk IN (1, 4, 6) THEN vlon ELSE elon END AS lon, coalesce(CASE WHEN rk IN (1, 4, 6) THEN vf WHEN rk IS NOT NULL THEN ef END, '') AS coords_fuente, n_fallecidos_total,
 CASE WHEN fuente = 'edan+visita' THEN trust ELSE round(0.2::DOUBLE + CASE WHEN road1 <> 0 THEN 0.1 ELSE 0.0 END::DOUBLE + CASE WHEN rk IS NOT NULL THEN 0.1 ELSE 0.0 END::DOUBLE + CASE WHEN coalesce(trim(barrio_unificado), '') NOT IN ('', '-') THEN 0.05 ELSE 0.0 END::DOUBLE, 2) END AS trust_score FROM r)"""
_ALL = f"{_PRE}, {_CASCADE}, {_TRUST}, {_GEO_KEY}, {_MASTER}"


def _records(spark: SparkSession, sf_dir: str) -> DataFrame:
    m, v, e = matched(spark, sf_dir)
    return integrate.integrated(integrate.master(e, m, v))


@query(f"{_ALL} SELECT * FROM i")
def site_linkage(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _records(spark, sf_dir)


@query(f"{_ALL} SELECT registro_id, trust_score, lat, lon FROM i WHERE trust_score > 0.7")
def reliable_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    return integrate.reliable(_records(spark, sf_dir)).select("registro_id", "trust_score", "lat", "lon")


@query(f"{_ALL} SELECT registro_id, fuente, trust_score, match_method, sitio_id, visita_id, direccion_unificada, barrio_unificado, lat, lon, n_fallecidos_total FROM i")
def consolidated_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    return integrate.consolidated(_records(spark, sf_dir))


@query(f"{_ALL} SELECT count(*) AS visitas, count(sitio_id) AS matches, round(100.0::DOUBLE * count(sitio_id) / greatest(count(*), 1), 1) AS tasa_pct, count(DISTINCT sitio_id) AS sitios, round(avg(trust), 6) AS trust_mean, min(trust) AS trust_min, median(trust) AS trust_median FROM final")
def match_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.match_metrics(matched(spark, sf_dir)[0])


@query(f"{_ALL} SELECT match_method, count(*) AS n, round(avg(trust), 6) AS trust_mean, min(trust) AS trust_min FROM final WHERE sitio_id IS NOT NULL GROUP BY match_method")
def trust_by_method(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.by_method(matched(spark, sf_dir)[0])


@query(f"{_ALL} SELECT bin, CAST(count(trust) AS BIGINT) AS n FROM (VALUES ('[0.70, 0.80)', 0.70::DOUBLE, 0.80::DOUBLE), ('[0.80, 0.90)', 0.80::DOUBLE, 0.90::DOUBLE), ('[0.90, 0.95)', 0.90::DOUBLE, 0.95::DOUBLE), ('[0.95, 1.01)', 0.95::DOUBLE, 1.01::DOUBLE)) AS x(bin, a, b) LEFT JOIN final ON trust >= a AND trust < b GROUP BY bin")
def trust_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.trust_histogram(matched(spark, sf_dir)[0])


@query(f"{_ALL} SELECT fuente, count(*) AS n, round(avg(trust_score), 6) AS trust_mean, count(lat) AS con_coords FROM i GROUP BY fuente")
def records_by_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.by_source(_records(spark, sf_dir))


@query(f"{_ALL} SELECT CASE WHEN coords_fuente = '' THEN 'ninguna' ELSE coords_fuente END AS coords_fuente, count(*) AS n FROM i GROUP BY 1")
def coords_by_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.coords_by_source(_records(spark, sf_dir))


# The queries above stop at the six tiers that their SQL states. These run all ten; SQL has no text or embedding tier.
def _full_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    m, v, e = fully_matched(spark, sf_dir)
    return integrate.integrated(integrate.master(e.drop("emb"), m, v.drop("emb")))


@query()
def full_cascade_matches(spark: SparkSession, sf_dir: str) -> DataFrame:
    return linkage.cascade(*with_embeddings(spark, sf_dir, *both(spark, sf_dir)))


@query()
def full_trusted_matches(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fully_matched(spark, sf_dir, last=False)[0]


@query()
def full_geo_key_matches(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fully_matched(spark, sf_dir)[0]


@query()
def full_site_linkage(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _full_records(spark, sf_dir)


@query()
def full_reliable_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    return integrate.reliable(_full_records(spark, sf_dir)).select("registro_id", "trust_score", "lat", "lon")


@query()
def full_consolidated_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    return integrate.consolidated(_full_records(spark, sf_dir))


@query()
def full_match_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.match_metrics(fully_matched(spark, sf_dir)[0])


@query()
def full_trust_by_method(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.by_method(fully_matched(spark, sf_dir)[0])


@query()
def full_trust_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.trust_histogram(fully_matched(spark, sf_dir)[0])


@query()
def full_records_by_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.by_source(_full_records(spark, sf_dir))


@query()
def full_coords_by_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.coords_by_source(_full_records(spark, sf_dir))


@query(f"SELECT 'coords' AS seccion, unnest(['total', 'con_coords', 'pct']) AS metrica, unnest([n, k, round(100.0 * k / greatest(n, 1), 2)]) AS valor FROM (SELECT CAST(count(*) AS DOUBLE) AS n, CAST(count(lat) AS DOUBLE) AS k FROM ({SITES}))")
def flat_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.flatten(metrics.coverage(sites(spark, sf_dir)), "coords")
