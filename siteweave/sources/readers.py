"""Readers of all-text tables, nested records, polygon layers and folders of files."""

from __future__ import annotations

import random
import re
import string

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from siteweave.operators.order import numbered
from siteweave.shared import written


def text_table(spark: SparkSession, path: str, header: list[str] | None = None) -> DataFrame:
    """A CSV file as text throughout; short rows are padded, nothing is inferred."""
    reader = spark.read.option("header", True).option("inferSchema", False).option("mode", "PERMISSIVE").option("multiLine", True)
    return reader.schema(T.StructType([T.StructField(h, T.StringType()) for h in header])).csv(path) if header else reader.csv(path)


def recover_header(names: list[str]) -> list[str]:
    """An unnamed column (blank, or a dash) right between `Zona` and `Tipo` is `Barrio`, if there is none; no other is guessed."""
    if "Barrio" in names:
        return list(names)
    return ["Barrio" if n.strip() in ("", "-") and 0 < k < len(names) - 1 and names[k - 1].strip() == "Zona" and names[k + 1].strip() == "Tipo" else n for k, n in enumerate(names)]


def rename(df: DataFrame, exact: dict[str, str], prefix: dict[str, str] | None = None) -> DataFrame:
    """Columns renamed by whole name, and long ones by how they begin; missing columns are no error."""
    to = {c: exact[c] for c in df.columns if c in exact}
    to |= {c: new for c in df.columns if c not in to for start, new in (prefix or {}).items() if c.startswith(start)}
    return df.withColumnsRenamed(to)


def present(df: DataFrame, *names: str) -> list[str]:
    return [n for n in names if n in df.columns]


def not_empty(df: DataFrame, but: tuple[str, ...] = ()) -> DataFrame:
    """Rows with something in a column besides those named; annulled rows go."""
    cols = [c for c in df.columns if c not in but]
    kept = df.where(F.exists(F.array(*(F.trim(F.coalesce(F.col(c), F.lit(""))) for c in cols)), lambda x: ~x.isin("", "-")))
    return kept.where(F.upper(F.coalesce(F.col("estado"), F.lit(""))) != "ANULADO") if "estado" in df.columns else kept


def id_sequence(n: int, seed: int, taken: set[str] = frozenset(), length: int = 4) -> list[str]:
    """n new ids of a seeded sequence, without those taken and those that read as numbers; an error if there aren't so many."""
    rng, out, seen = random.Random(seed), [], set(taken)
    usable = re.compile(rf"(?!\d+$|\d+E\d+$)[A-Z0-9]{{{length}}}")
    free = 36**length - 10**length - max(0, length - 2) * 10 ** (length - 1) - sum(bool(usable.fullmatch(x)) for x in seen)
    if n > free:
        raise ValueError(f"{n} ids of {length} signs are asked for, {free} are free")
    while len(out) < n:
        new = "".join(rng.choices(string.ascii_uppercase + string.digits, k=length))
        if new not in seen and not re.fullmatch(r"\d+|\d+E\d+", new):
            seen.add(new)
            out.append(new)
    return out


def _drawn(spark: SparkSession, seed: int, length: int, n: int) -> DataFrame:
    """(_j, _id): the first n draws of the seeded sequence, made in a task; repeats are in it."""

    def draw(batches):
        rng = random.Random(seed)
        for _ in batches:
            for start in range(0, n, 65_536):
                end = min(n, start + 65_536)
                yield pd.DataFrame({"_j": range(start, end), "_id": ["".join(rng.choices(string.ascii_uppercase + string.digits, k=length)) for _ in range(start, end)]})

    return spark.range(0, 1, 1, 1).mapInPandas(draw, "_j long, _id string")


def _permuted(spark: SparkSession, seed: int, length: int, n: int) -> DataFrame:
    """(_j, _id): the first n ids of a keyed permutation of all ids of this length: four rounds over halves of 6 ** length."""
    half = 6**length
    l, r = F.floor(F.col("id") / half), F.col("id") % half  # noqa: E741
    out = spark.range(n).select("id", l.alias("l"), r.alias("r"))
    for k in range(4):
        out = out.select("id", F.col("r").alias("l"), F.pmod(F.col("l") + F.pmod(F.xxhash64(F.lit(seed), F.lit(k), "r"), F.lit(half)), F.lit(half)).alias("r"))
    signs, whole = F.lit(string.ascii_uppercase + string.digits), F.col("l") * half + F.col("r")
    sign = lambda k: F.substring(signs, (F.floor(whole / 36**k) % 36 + 1).cast("int"), F.lit(1))
    return out.select(F.col("id").alias("_j"), F.concat(*(sign(k) for k in range(length))).alias("_id"))


def new_ids(spark: SparkSession, n: int, taken: DataFrame, seed: int, length: int = 4, drawn: int = 100_000) -> DataFrame:
    """(_k from 1, _id): n new ids without those taken (a table of one column, _id) and those that read as numbers; an error if
    there aren't so many.

    Up to `drawn` new ids are those of id_sequence(), drawn in a task; more are numbered along a keyed permutation of the id
    space, so no task makes or holds all of them. Nothing is collected.
    """
    usable = F.col("_id").rlike(rf"^[A-Z0-9]{{{length}}}$") & ~F.col("_id").rlike(r"^(\d+|\d+E\d+)$")
    taken = written(taken.where(usable).select("_id").distinct(), "taken")
    numberlike = 10**length + max(0, length - 2) * 10 ** (length - 1)
    held = taken.count()
    if n > 36**length - numberlike - held:
        raise ValueError(f"{n} ids of {length} signs are asked for, {36**length - numberlike - held} are free")
    if n > drawn:
        # At most held + numberlike of these are left out.
        rows = _permuted(spark, seed, length, min(36**length, n + held + numberlike))
        return numbered(rows.where(usable).join(taken, "_id", "left_anti"), [F.col("_j")], "_k").where(F.col("_k") <= n).select("_k", "_id")
    draws = 2 * n + 64
    while True:
        firsts = _drawn(spark, seed, length, draws).where(usable).groupBy("_id").agg(F.min("_j").alias("_j"))
        got = numbered(firsts.join(taken, "_id", "left_anti"), [F.col("_j")], "_k").where(F.col("_k") <= n)
        if got.count() == n:
            return got.select("_k", "_id")
        draws *= 4


def fill_ids(df: DataFrame, column: str, order: str, seed: int, length: int = 4, drawn: int = 100_000) -> DataFrame:
    """df with its blank ids filled in order by new_ids(); the others stay. `order` must be total among the rows without an id."""
    blank = F.trim(F.coalesce(F.col(column), F.lit(""))) == ""
    n = df.where(blank).count()
    if not n:
        return df
    new = new_ids(df.sparkSession, n, df.where(~blank).select(F.col(column).alias("_id")), seed, length, drawn)
    filled = numbered(df.where(blank), [F.col(order)], "_k").join(new, "_k").withColumn(column, F.col("_id"))
    return df.where(~blank).unionByName(filled.select(*df.columns))


def cases(df: DataFrame) -> DataFrame:
    """Nested case records as text columns, with the evaluation before the intake where both have a value."""
    at = lambda *names: F.coalesce(*(F.when(F.col(n).cast("string") != "", F.col(n).cast("string")) for n in names), F.lit(""))
    return df.select(
        at("id").alias("registro_id"), at("estadoEtiqueta", "estado").alias("estado"), at("direccion").alias("direccion"), at("barrio").alias("barrio"),
        F.when(F.col("lat").isNull() | F.col("lng").isNull(), "").otherwise(F.format_string("%.6f, %.6f", "lat", "lng")).alias("coords"),
        F.when(F.col("evaluacion.tipoColapso") == "A", "si").otherwise("").alias("requiere_demolicion"), at("evaluacion.id").alias("evaluacion_id"), F.col("evaluacion.creado_utc").alias("creado_utc"),
        *(at(f"evaluacion.victimas.{n}").alias(f"n_{n}") for n in ("fallecidos", "atrapados", "rescatados")),
    )


def local_date(epoch_ms: Column, zone: str = "America/Bogota") -> Column:
    """The local date of an epoch in milliseconds; null for what is none."""
    return F.to_date(F.from_utc_timestamp(F.timestamp_millis(epoch_ms.try_cast("long")), zone))


#: Names under which a parcel's id may stand, by preference, in upper case.
PARCEL_IDS = ("NPN", "CODIGO_PREDIAL", "CODIGO_PRE", "CBML", "LOTE_CODIGO", "CODIGO", "COD_PREDIO", "PREDIO", "MANZANA_LO", "OBJECTID", "FID")


def polygons(spark: SparkSession, path: str, ids: tuple[str, ...] = PARCEL_IDS) -> DataFrame:
    """(pos, id, rings) of a GeoJSON file: polygons, and each part of multipolygons; the id by order of preference."""
    raw = spark.read.text(path, wholetext=True).select(F.explode(F.from_json("value", "features array<struct<geometry:struct<type:string,coordinates:string>,properties:map<string,string>>>").getField("features")).alias("f"), F.monotonically_increasing_id().alias("_file"))
    one = F.from_json("f.geometry.coordinates", "array<array<array<double>>>")
    many = F.from_json("f.geometry.coordinates", "array<array<array<array<double>>>>")
    parts = F.when(F.col("f.geometry.type") == "Polygon", F.array(one)).when(F.col("f.geometry.type") == "MultiPolygon", many)
    # Keys that differ in case only: the last one counts.
    entries = F.map_entries(F.coalesce("f.properties", F.create_map().cast("map<string,string>")))
    value = lambda i: F.element_at(F.filter(entries, lambda x: (F.upper(x["key"]) == i) & (F.trim(F.coalesce(x["value"], F.lit(""))) != "")), -1)["value"]
    scalar = F.filter(entries, lambda x: (F.coalesce(x["value"], F.lit("")) != "") & ~x["value"].rlike(r"^[\[{]"))
    held = lambda i: F.when(F.exists(entries, lambda x: (F.upper(x["key"]) == i) & (F.trim(F.coalesce(x["value"], F.lit(""))) != "")), F.trim(value(i)))
    name = F.coalesce(*(held(i) for i in ids), F.get(scalar, F.lit(0))["value"], F.lit(""))
    rings = F.transform("part", lambda ring: F.transform(ring, lambda p: F.struct(p[0].alias("x"), p[1].alias("y"))))
    out = raw.select("_file", name.alias("id"), F.explode(parts).alias("part")).select("id", rings.alias("rings"))
    return out.withColumn("pos", F.monotonically_increasing_id())


def first_with_rows(spark: SparkSession, paths: list[str]) -> DataFrame | None:
    """The polygons of the first of several files that holds any; None if none does."""
    for path in paths:
        found = polygons(spark, path)
        if not found.isEmpty():
            return found
    return None


def distinct_features(features: DataFrame, geometry: str = "geometry", prefix: int = 200) -> DataFrame:
    """Features of overlapping tiles once: told apart by the beginning of their geometry's text, the first (pos) stays."""
    start = F.substring(F.col(geometry), 1, prefix)
    from siteweave.operators.crossmatch import latest

    return latest(features.withColumns({"_g": start, "_t": F.lit(0)}), "_g", "_t", "pos").drop("_g", "_t")


def kml_zones(spark: SparkSession, path: str, folder: str = "zonas") -> DataFrame:
    """(pos, id, rings, description) of the polygon placemarks in folders whose name holds the given word; outer rings of three
    points or more. Spark's XML reader takes the placemarks apart."""
    rows = spark.read.format("xml").option("rowTag", "Folder").load(path)
    marks = rows.where(F.lower("name").contains(folder)).select(F.explode("Placemark").alias("m"))
    text = F.col("m.Polygon.outerBoundaryIs.LinearRing.coordinates")
    ring = F.transform(F.filter(F.split(F.trim(text), r"\s+"), lambda t: t != ""), lambda t: F.struct(F.split(t, ",")[0].cast("double").alias("x"), F.split(t, ",")[1].cast("double").alias("y")))
    return marks.where(text.isNotNull()).select(F.monotonically_increasing_id().alias("pos"), F.col("m.name").cast("string").alias("id"), F.array(ring).alias("rings"), F.col("m.description").alias("description")).where(F.size(F.col("rings")[0]) >= 3)


def described(description: Column) -> dict[str, Column]:
    """Fields of a zone's description."""
    return {n: F.regexp_extract(description, rf"(?iU)\b{n}\s*:\s*([^<\n;]*)", 1) for n in ("ola", "despacho", "comuna", "barrios", "carga")}


def occupied_tiles(points: DataFrame, step: float = 0.01, pad: float = 0.0025) -> DataFrame:
    """The padded boxes of the grid cells that hold points."""
    cells = points.where("lat is not null and lon is not null").select(F.floor(F.col("lat") / step).alias("cy"), F.floor(F.col("lon") / step).alias("cx")).distinct()
    return cells.select("cy", "cx", (F.col("cy") * step - pad).alias("lat_min"), ((F.col("cy") + 1) * step + pad).alias("lat_max"), (F.col("cx") * step - pad).alias("lon_min"), ((F.col("cx") + 1) * step + pad).alias("lon_max"))
