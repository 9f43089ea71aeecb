"""Positions in image bytes, and landings of pages."""

import json
import struct

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from siteweave.sources import images, paged

VISITS = "pos long, visita_id string, evidencia_soporte string"


def tiff(order, lat, lon, sides=(b"N", b"W"), first=8):
    """A TIFF block with a position: angles as (degrees, minutes, hundredths of a second)."""
    angle = lambda a: struct.pack(f"{order}6I", a[0], 1, a[1], 1, a[2], 100)
    ifd, data = first + 18, first + 18 + 54
    entry = lambda tag, kind, n, raw: struct.pack(f"{order}HHI", tag, kind, n) + raw
    where = lambda n: struct.pack(f"{order}I", n)
    head = (b"II" if order == "<" else b"MM") + struct.pack(f"{order}HI", 42, first) + b"\0" * (first - 8)
    root = struct.pack(f"{order}H", 1) + entry(0x8825, 4, 1, where(ifd)) + where(0)
    gps = struct.pack(f"{order}H", 4) + entry(1, 2, 2, sides[0] + b"\0\0\0") + entry(2, 5, 3, where(data)) + entry(3, 2, 2, sides[1] + b"\0\0\0") + entry(4, 5, 3, where(data + 24)) + where(0)
    return head + root + gps + angle(lat) + angle(lon)


def jpeg(block, before=b""):
    body = b"Exif\0\0" + block
    return b"\xff\xd8" + before + b"\xff\xe1" + struct.pack(">H", len(body) + 2) + body + b"\xff\xda\0\2scan\xff\xd9"


def png(block):
    chunk = lambda kind, body: struct.pack(">I", len(body)) + kind + body + b"\0" * 4
    return b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", b"\0" * 13) + chunk(b"eXIf", block) + chunk(b"IEND", b"")


CITY = ((3, 27, 1800), (76, 31, 4800))
WANT = (3 + 27 / 60 + 18 / 3600, -(76 + 31 / 60 + 48 / 3600))


def test_positions_of_images():
    for order in "<>":
        block = tiff(order, *CITY)
        app0 = b"\xff\xe0\0\x04ab" + b"\xff\xff\xe2\0\x02"  # another segment, and a fill byte
        for data in (block, jpeg(block), jpeg(block, app0), png(block), jpeg(tiff(order, *CITY, first=40))):
            assert images.image_position(data) == pytest.approx(WANT)
        assert images.image_position(jpeg(tiff(order, *CITY, sides=(b"S", b"E")))) == pytest.approx((-WANT[0], -WANT[1]))
        assert images.image_position(jpeg(tiff(order, (91, 0, 0), (0, 0, 0)))) is None
        for cut in range(len(jpeg(block)) - 10):  # damaged anywhere: nothing, and no error
            assert images.image_position(jpeg(block)[:cut]) is None
        for at in range(len(block)):
            images.image_position(jpeg(block[:at] + b"\xff" + block[at + 1 :]))
    zero = tiff("<", *CITY).replace(struct.pack("<I", 100), struct.pack("<I", 0))
    assert images.image_position(zero) is None
    assert [images.image_position(x) for x in (None, b"", b"\xff\xd8", b"GIF89a", b"\xff\xd8\xff\xe1\0\0" * 9)] == [None] * 5


def test_images_meet_visits_by_name(spark, tmp_path):
    (tmp_path / "deep").mkdir()
    a, b = "a" * 22, "b" * 25
    for name, data in {f"x_{a}.JPG": jpeg(tiff("<", *CITY)), f"deep/V2-{b}.png": png(tiff(">", *CITY)), "deep/foto V2 3.tif": tiff("<", *CITY), "V1.gif": jpeg(tiff("<", *CITY)), "V1.jpeg": jpeg(tiff("<", (40, 0, 0), (3, 0, 0))), "V1b.jpg": b"x", "nobody.jpg": jpeg(tiff("<", *CITY))}.items():
        (tmp_path / name).write_bytes(data)
    files = images.image_files(spark, str(tmp_path))
    assert files.count() == 6 and files.where("lat is null").count() == 1
    visits = spark.createDataFrame([(0, "V1", f"https://x/d/{a}"), (1, "V2", f"https://x/d/{a} id={b}"), (2, "", None)], VISITS)
    got = {r["path"].split("/")[-1]: (r["visita_id"], round(r["lat"], 6)) for r in images.positions_by_name(files, visits).collect()}
    # The shared file is the first visit's; places off the city and names without an id are left out.
    assert {k.replace("%20", " "): v for k, v in got.items()} == {f"x_{a}.JPG": ("V1", round(WANT[0], 6)), f"V2-{b}.png": ("V2", round(WANT[0], 6)), "foto V2 3.tif": ("V2", round(WANT[0], 6))}
    assert images.positions_by_name(files.limit(0), visits).count() == 0 and images.positions_by_name(files, visits.limit(0)).count() == 0


def land(folder, number, ids, more, **extra):
    rows = [{"attributes": {"objectid": i, "globalid": f"{{G{i}}}", "fecha_inspeccion": 1786000000000, "nombre_evaluador": None}, "geometry": {"x": -76.5, "y": 3.4} if i % 2 else None} for i in ids]
    (folder / f"page-{number}.json").write_text(json.dumps({"features": rows, "exceededTransferLimit": more, **extra}))


def test_pages(spark, tmp_path):
    folder = tmp_path / "pages"
    folder.mkdir()
    assert paged.paged_features(spark, str(folder)).count() == 0
    for n, ids in enumerate(([1, 2, 3], [4, 5], [])):
        land(folder, n, ids, n < 2)
    (folder / "notes.txt").write_text("no page")
    df = paged.paged_features(spark, f"file://{folder}")
    assert df.rdd.getNumPartitions() == 3 and paged.page_faults(df).count() == 0
    got = sorted(map(tuple, paged.inspections_of(df).select("gid", "rlat", "rlon", "fecha").collect()))
    assert got == [(f"g{i}", 3.4 if i % 2 else None, -76.5 if i % 2 else None, "2026-08-06") for i in range(1, 6)]
    land(folder, 1, [3, 3], False)
    land(folder, 4, [9], True)
    df = paged.paged_features(spark, str(folder))  # a table knows the pages that were there when it was made
    assert sorted(map(tuple, paged.page_faults(df).collect())) == [(1, "overlap"), (1, "unordered"), (2, "after_the_end"), (4, "missing"), (5, "missing")]
    land(folder, 0, [1], True, error={"code": 500})
    with pytest.raises(PySparkException, match="holds an error"):
        df.count()


def test_pages_as_a_stream(spark, tmp_path):
    folder = tmp_path / "pages"
    folder.mkdir()
    land(folder, 0, [1, 2], True)
    land(folder, 2, [5], False)  # comes before its turn
    out, cp = str(tmp_path / "out"), str(tmp_path / "cp")
    run = lambda: paged.stream_features(spark, str(folder)).writeStream.format("parquet").option("path", out).option("checkpointLocation", cp).trigger(once=True).start().awaitTermination()
    ids = lambda: sorted(r[0] for r in spark.read.parquet(out).select(F.col("objectid")).collect())
    run()
    assert ids() == [1, 2]
    land(folder, 1, [3, 4], True)
    run()
    run()  # a restart: no page is read twice
    assert ids() == [1, 2, 3, 4, 5]
