"""Positions that cameras write into image files."""

from __future__ import annotations

import struct

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from siteweave.functions.coords import CITY, within
from siteweave.sources.loaders import file_visits

#: Endings of image files, the tag of the position's directory, and in it those of sides and angles.
ENDINGS = ("jpg", "jpeg", "png", "heic", "tif", "tiff")
GPS_DIRECTORY, LAT_SIDE, LAT, LON_SIDE, LON = 0x8825, 1, 2, 3, 4
#: Bytes of a value of each TIFF type.
WIDTH = {1: 1, 2: 1, 3: 2, 4: 4, 5: 8, 6: 1, 7: 1, 8: 2, 9: 4, 10: 8, 11: 4, 12: 8, 13: 4}


def _tiff_part(data: bytes) -> bytes | None:
    """The TIFF block of a JPEG (first Exif segment before the scan), of a PNG (eXIf chunk), or the file itself if it is one."""
    if data[:4] in (b"II*\0", b"MM\0*"):
        return data
    if data[:8] == b"\x89PNG\r\n\x1a\n":
        at = 8
        while at + 8 <= len(data):
            size, kind = struct.unpack_from(">I4s", data, at)
            if kind == b"eXIf":
                return data[at + 8 : at + 8 + size]
            at += size + 12
        return None
    if data[:2] != b"\xff\xd8":
        return None
    at = 2
    while at + 4 <= len(data) and data[at] == 0xFF:
        mark = data[at + 1]
        if mark == 0xFF:  # a fill byte
            at += 1
            continue
        if mark in (0xDA, 0xD9):
            return None
        if mark == 0x01 or 0xD0 <= mark <= 0xD7:  # without a length
            at += 2
            continue
        (size,) = struct.unpack_from(">H", data, at + 2)
        if mark == 0xE1 and data[at + 4 : at + 10] == b"Exif\0\0":
            return data[at + 10 : at + 2 + size]
        at += 2 + max(size, 2)
    return None


def _directory(block: bytes, order: str, at: int, wanted: tuple[int, ...]) -> dict[int, tuple]:
    """The wanted entries of a directory: (type, count, bytes)."""
    (n,) = struct.unpack_from(f"{order}H", block, at)
    out = {}
    for k in range(n):
        tag, kind, count = struct.unpack_from(f"{order}HHI", block, at + 2 + 12 * k)
        if tag not in wanted or kind not in WIDTH or count > 64:
            continue
        where, size = at + 2 + 12 * k + 8, WIDTH[kind] * count
        if size > 4:
            (where,) = struct.unpack_from(f"{order}I", block, where)
        if where + size <= len(block):
            out[tag] = (kind, count, block[where : where + size])
    return out


def _angle(entry: tuple, order: str) -> float:
    kind, count, raw = entry
    if kind not in (5, 10) or count < 3:
        raise ValueError("an angle has three fractions")
    top = struct.unpack_from(f"{order}6{'I' if kind == 5 else 'i'}", raw)
    d, m, s = (top[k] / top[k + 1] for k in (0, 2, 4))
    return d + m / 60 + s / 3600


def image_position(data: bytes | None) -> tuple[float, float] | None:
    """(lat, lon) of an image's bytes; None without a position, for damaged files and for angles off the globe."""
    try:
        block = _tiff_part(data or b"")
        if block is None:
            return None
        order = {b"II": "<", b"MM": ">"}[bytes(block[:2])]
        (first,) = struct.unpack_from(f"{order}I", block, 4)
        found = _directory(block, order, first, (GPS_DIRECTORY,))[GPS_DIRECTORY]
        gps = _directory(block, order, struct.unpack_from(f"{order}I", found[2])[0], (LAT_SIDE, LAT, LON_SIDE, LON))
        side = lambda tag: gps[tag][2][:1].upper() if tag in gps else b""
        lat = _angle(gps[LAT], order) * (-1 if side(LAT_SIDE) == b"S" else 1)
        lon = _angle(gps[LON], order) * (-1 if side(LON_SIDE) == b"W" else 1)
    except (struct.error, KeyError, ValueError, ZeroDivisionError, IndexError):
        return None
    return (lat, lon) if -90 <= lat <= 90 and -180 <= lon <= 180 else None


@F.pandas_udf(T.StructType([T.StructField(n, T.DoubleType()) for n in ("lat", "lon")]))
def position(content: pd.Series) -> pd.DataFrame:
    """image_position() of a column of bytes."""
    return pd.DataFrame([image_position(c) or (None, None) for c in content], columns=["lat", "lon"], dtype="float64")


def image_files(spark: SparkSession, folder: str) -> DataFrame:
    """(path, name, stem, lat, lon) of the image files below a folder, at any depth; lat and lon are null without a position.
    Spark lists no empty files."""
    rows = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(folder)
    name = F.element_at(F.split("path", "/"), -1)
    rows = rows.withColumn("name", name).where(F.lower(F.regexp_extract("name", r"\.([^.]+)$", 1)).isin(*ENDINGS))
    return rows.select("path", "name", F.regexp_replace("name", r"\.[^.]+$", "").alias("stem"), position("content").alias("p")).select("path", "name", "stem", "p.lat", "p.lon")


def positions_by_name(files: DataFrame, visits: DataFrame) -> DataFrame:
    """(visita_id, path, lat, lon) of image_files() inside the city whose name tells the visit (pos, visita_id, evidencia_soporte):
    it holds the id of one of the visit's files anywhere, or else its stem holds the visit's id; of several, the first visit's.

    Names meet ids by equality: a name gives its pieces of the lengths that ids have, so no file is compared with every id.
    """
    usable = files.where(within(CITY, F.col("lat"), F.col("lon"))).select("path", "name", "stem", "lat", "lon")
    first = visits.where("trim(visita_id) <> ''").groupBy("visita_id").agg(F.min("pos").alias("pos"))
    linked = file_visits(visits).join(first, "visita_id").select(F.col("file_id").alias("id"), "visita_id", "pos")

    def meet(rows: DataFrame, column: str, ids: DataFrame, grade: int) -> DataFrame:
        lengths = ids.agg(F.collect_set(F.length("id")).alias("lengths"))  # one row, one entry for each length of an id
        pieces = lambda n: F.transform(F.sequence(F.lit(1), F.length(column) - n + 1), lambda i: F.substring(F.col(column), i, n))
        fits = F.filter("lengths", lambda n: n <= F.length(column))
        cut = rows.crossJoin(F.broadcast(lengths)).withColumn("id", F.explode(F.array_distinct(F.flatten(F.transform(fits, pieces))))).drop("lengths")
        return cut.join(ids, "id").select("path", "lat", "lon", "visita_id", "pos", F.lit(grade).alias("grade"), F.col("id").alias("by"))

    both = meet(usable, "name", linked, 0).unionByName(meet(usable, "stem", first.select(F.col("visita_id").alias("id"), "visita_id", "pos"), 1))
    rank = F.row_number().over(Window.partitionBy("path").orderBy("grade", "pos", "by"))
    return both.withColumn("_n", rank).where("_n = 1").select("visita_id", "path", "lat", "lon")
