"""Sites, visits and the other inputs, derived from the star-schema tables by arithmetic on their keys.

The select lists are written once, in SQL that Spark and DuckDB read alike.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

_ROAD = "CASE {k} % 3 WHEN 0 THEN '{a}' WHEN 1 THEN '{b}' ELSE '{c}' END"
_BARRIO = "CASE {k} % 6 WHEN 0 THEN 'El Lido' WHEN 1 THEN 'Ciudad Jardin' WHEN 2 THEN 'San Fernando' WHEN 3 THEN 'Granada' WHEN 4 THEN '-' ELSE 'Villa del Sur' END"
_LAT, _LON = "3.43 + CAST(({k} * 7919) % 6000 AS DOUBLE) / 1e5", "-76.54 + CAST(({k} * 104729) % 6000 AS DOUBLE) / 1e5"


def _street(k: str, road: str, plate: str = "0") -> str:
    letter = f"CASE WHEN {k} % 5 = 0 THEN 'A' ELSE '' END"
    return f"concat({road}, ' ', {k} % 40 + 1, {letter}, ' # ', {k} % 23 + 1, '-', {k} % 97 + 1 + {plate})"


_CODE, _WORD = _ROAD.format(k="{k}", a="CL", b="KR", c="AV"), _ROAD.format(k="{k}", a="Calle", b="Carrera", c="Avenida")
SITES = f"""SELECT c_custkey AS pos, concat('S', c_custkey) AS sitio_id, concat({_street('c_custkey', _CODE.format(k='c_custkey'))}, ', Cali') AS direccion_norm,
 {_BARRIO.format(k='c_custkey')} AS barrio, CASE WHEN c_custkey % 4 <> 1 THEN {_LAT.format(k='c_custkey')} END AS lat, CASE WHEN c_custkey % 4 <> 1 THEN {_LON.format(k='c_custkey')} END AS lon,
 CASE c_custkey % 3 WHEN 0 THEN 'edan_tecleada' WHEN 1 THEN 'geocode' ELSE 'exif' END AS coords_fuente,
 CASE WHEN c_custkey % 7 = 0 THEN 'No' WHEN c_custkey % 50 = 9 THEN '9' ELSE CAST(c_custkey AS STRING) END AS consecutivo,
 CASE WHEN c_custkey % 9 = 0 THEN NULL ELSE c_custkey % 4 END AS n_fallecidos, c_nationkey AS nation FROM customer"""
_O = "o_custkey"
VISITS = f"""SELECT o_orderkey AS vpos, concat('V', o_orderkey) AS visita_id, o_custkey AS true_pos,
 CASE o_orderkey % 8 WHEN 0 THEN concat({_street(_O, _CODE.format(k=_O))}, ', Cali') WHEN 1 THEN concat({_street(_O, _CODE.format(k=_O))}, ' APTO ', o_orderkey % 9 + 1, ', Cali')
 WHEN 2 THEN concat({_street(_O, _CODE.format(k=_O), 'o_orderkey % 60')}, ', Cali') WHEN 3 THEN concat('KR ', {_O} % 23 + 1, ' CON CL ', {_O} % 40 + 1, CASE WHEN {_O} % 5 = 0 THEN 'A' ELSE '' END, ', Cali')
 WHEN 4 THEN concat('EDIFICIO SIN NUMERO, Cali') WHEN 5 THEN '' WHEN 6 THEN concat({_street(_O, _CODE.format(k=_O))}, ' LOCAL 2, Cali') ELSE NULL END AS direccion_norm,
 CASE WHEN o_orderkey % 13 = 0 THEN '' ELSE {_BARRIO.format(k=_O)} END AS barrio,
 CASE WHEN o_orderkey % 4 <> 3 THEN {_LAT.format(k=_O)} + CAST(o_orderkey % 11 - 5 AS DOUBLE) * 1e-4 END AS lat,
 CASE WHEN o_orderkey % 4 <> 3 THEN {_LON.format(k=_O)} + CAST(o_orderkey % 7 - 3 AS DOUBLE) * 1e-4 END AS lon,
 CASE o_orderkey % 3 WHEN 0 THEN 'exif' WHEN 1 THEN 'geocode' ELSE 'visita_tecleada' END AS coords_fuente,
 CASE WHEN o_orderkey % 11 = 0 THEN CAST(o_custkey AS STRING) WHEN o_orderkey % 11 = 1 THEN '00' ELSE 'No tengo' END AS consecutivo,
 CASE WHEN o_orderkey % 5 = 0 THEN NULL ELSE o_orderkey % 3 END AS n_fallecidos FROM orders"""
#: Addresses as people type them, beside what they should become.
TYPED = f"""SELECT c_custkey AS id, CASE c_custkey % 4 WHEN 0 THEN concat({_WORD.format(k='c_custkey')}, ' ', c_custkey % 40 + 1, ' No. ', c_custkey % 23 + 1, '-', c_custkey % 97 + 1, ', barrio el lido')
 WHEN 1 THEN concat({_ROAD.format(k='c_custkey', a='CLL', b='Kra', c='Av.')}, ' ', c_custkey % 40 + 1, '  Num ', c_custkey % 23 + 1, '-', c_custkey % 97 + 1) WHEN 2 THEN '-' ELSE NULL END AS raw,
 CASE c_custkey % 4 WHEN 0 THEN concat({_CODE.format(k='c_custkey')}, ' ', c_custkey % 40 + 1, ' # ', c_custkey % 23 + 1, '-', c_custkey % 97 + 1, ', Barrio El Lido')
 WHEN 1 THEN concat({_CODE.format(k='c_custkey')}, ' ', c_custkey % 40 + 1, ' # ', c_custkey % 23 + 1, '-', c_custkey % 97 + 1) WHEN 2 THEN '-' ELSE '' END AS expected FROM customer"""


#: Rows of a task where the work on each row is long.
SPREAD = 100_000


def view(spark: SparkSession, sf_dir: str, sql: str, spread: bool = False) -> DataFrame:
    """The derived table, over the Parquet table that its FROM names; if `spread`, dealt to tasks by rows, as few bytes of
    keys become long rows that are costly to parse."""
    base = sql.rsplit("FROM ", 1)[1].split()[0]
    rows = spark.read.parquet(f"{sf_dir}/{base}.parquet")
    if spread:
        used = [c for c in rows.columns if re.search(rf"\b{c}\b", sql)]
        rows = rows.select(*used)
        rows = rows.repartition(max(spark.sparkContext.defaultParallelism, -(-rows.count() // SPREAD)))
    return rows.selectExpr(*_items(sql))


def _items(sql: str) -> list[str]:
    """The select list, cut at commas outside brackets and quotes."""
    body, out, depth, quoted, start = sql.strip()[len("SELECT ") :].rsplit(" FROM ", 1)[0], [], 0, False, 0
    for k, c in enumerate(body):
        if c == "'":
            quoted = not quoted
        elif not quoted:
            depth += (c == "(") - (c == ")")
            if c == "," and not depth:
                out.append(body[start:k])
                start = k + 1
    return [*out, body[start:]]


def sites(spark: SparkSession, sf_dir: str, spread: bool = False) -> DataFrame:
    return view(spark, sf_dir, SITES, spread)


def visits(spark: SparkSession, sf_dir: str, spread: bool = False) -> DataFrame:
    return view(spark, sf_dir, VISITS, spread)
