"""What a run publishes: sheets, statistics, the web's JSON and GeoJSON, the report."""

from __future__ import annotations

from dataclasses import asdict

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siteweave.operators import linkage, metrics, roster
from siteweave.sources.sinks import cells

MATCH_COLUMNS = ("visita_id", "sitio_id", "match_method", "match_score", "trust")
#: Blank columns for the people who review.
REVIEW = ("decision", "revisor", "comentario")


def sheets(consolidated: DataFrame, reliable: DataFrame, matches: DataFrame, report: DataFrame) -> dict[str, DataFrame]:
    """The four sheets of a run; report: (seccion, metrica, valor)."""
    return {"consolidada": consolidated, "confiable": reliable, "matches": matches.where("sitio_id is not null").select(*MATCH_COLUMNS), "metricas": report.select(F.concat_ws(".", "seccion", "metrica").alias("metrica"), "valor")}


def review_sheets(matches: DataFrame, learned: DataFrame, band: DataFrame) -> dict[str, DataFrame]:
    """All matches, those of the learned model, those to be reviewed with blank columns, and counts by method."""
    blank = band.select("*", *(F.lit("").alias(c) for c in REVIEW))
    return {"todos_los_matches": matches, "matches_lm": learned, "revisar": blank, "resumen": metrics.by_method(matches)}


def write_sheets(parts: dict[str, DataFrame], folder: str) -> list[str]:
    """Each sheet as a CSV folder below `folder`, which must be new."""
    paths = []
    for name, df in parts.items():
        path = f"{folder}/{name}"
        cells(df).write.option("header", True).csv(path)
        paths.append(path)
    return paths


def threshold_rows(spark: SparkSession, config: linkage.MatchConfig = linkage.CONFIG) -> DataFrame:
    """(seccion, metrica, valor) of the settings that made a run's figures, read from what ran."""
    rows = [("umbrales", k, str(v)) for k, v in asdict(config).items()] + [("umbrales", f"trust_base.{k}", str(v)) for k, v in linkage.BASE_TRUST.items()]
    return spark.createDataFrame(rows, "seccion string, metrica string, valor string")


def run_rows(spark: SparkSession, info: dict) -> DataFrame:
    """(seccion, metrica, valor) of when, where and how a run was made."""
    return spark.createDataFrame([("ejecucion", str(k), "" if v is None else str(v)) for k, v in info.items()], "seccion string, metrica string, valor string")


def statistics(matches: DataFrame, records: DataFrame, info: dict | None = None, config: linkage.MatchConfig = linkage.CONFIG) -> DataFrame:
    """All rows of the statistics sheet: figures of matching and integration, settings, trust by method and by bin, the run."""
    spark = matches.sparkSession
    text = lambda d: d.select("seccion", "metrica", F.coalesce(F.round("valor", 6).cast("string"), F.lit("")).alias("valor"))
    by = metrics.by_method(matches)
    each = by.select(F.lit("trust_por_metodo").alias("seccion"), F.inline(F.array(*(F.struct(F.concat_ws(".", "match_method", F.lit(a)).alias("metrica"), F.col(b).cast("double").alias("valor")) for a, b in (("n", "n"), ("media", "trust_mean"), ("min", "trust_min"))))))
    bins = metrics.trust_histogram(matches).select(F.lit("trust_distribucion").alias("seccion"), F.col("bin").alias("metrica"), F.col("n").cast("double").alias("valor"))
    sources = metrics.by_source(records).select(F.lit("integracion").alias("seccion"), F.concat(F.lit("por_fuente."), "fuente").alias("metrica"), F.col("n").cast("double").alias("valor"))
    parts = [text(metrics.flatten(metrics.match_metrics(matches), "matching")), text(sources), threshold_rows(spark, config), text(each), text(bins)]
    if info:
        parts.append(run_rows(spark, info))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def web_roster(published: DataFrame, zones: int, now: str, folder: str) -> None:
    """The roster for the web: `records`, a folder of JSON lines in the roster's order with nulls written, and `summary`, one
    object with the counters. The records are written by all tasks; the driver holds only the counters."""
    roster.published_order(published).write.option("ignoreNullFields", "false").json(f"{folder}/records")
    counted = roster.counters(published).select(F.lit(now).alias("generated_at"), "pendientes", "visitados", "ede_hechas", "ede_pendientes", F.lit(zones).alias("zonas"))
    counted.coalesce(1).write.option("ignoreNullFields", "false").json(f"{folder}/summary")


def geojson_features(zones: DataFrame) -> DataFrame:
    """One GeoJSON feature a row, of zones (pos, zona_id, rings, ...): rings as closed [x, y] lists, other columns as properties."""
    closed = F.transform("rings", lambda r: F.transform(F.when(r[0] == F.element_at(r, -1), r).otherwise(F.concat(r, F.array(r[0]))), lambda p: F.array(p["x"], p["y"])))
    rest = [c for c in zones.columns if c not in ("pos", "rings")]
    feature = F.struct(F.lit("Feature").alias("type"), F.struct(*rest).alias("properties"), F.struct(F.lit("Polygon").alias("type"), closed.alias("coordinates")).alias("geometry"))
    return zones.select("pos", F.to_json(feature).alias("feature"))


def write_geojson(zones: DataFrame, folder: str) -> None:
    """Features as lines, in order."""
    geojson_features(zones).orderBy("pos").select("feature").write.text(folder)


def save_report(report: dict[str, DataFrame], folder: str) -> None:
    """Each section's one row of figures as a JSON object."""
    for name, one in report.items():
        one.coalesce(1).write.option("ignoreNullFields", "false").json(f"{folder}/{name}")
