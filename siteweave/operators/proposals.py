"""Which inspected buildings to propose for demolition: points of the inspection form, findings of its texts, classes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siteweave.operators.order import numbered
from siteweave.operators.triage import findings

# Grades of damage and severity, and what each answer of the form is worth and said to be.
GRADES = {"severo": 1.0, "moderado": 0.5}
SEVERITY = {"alto": 1.0, "medio_alto": 0.6, "medio": 0.3, "bajo": 0.1}
UNSAFE = ("i2", "i3")
TEXTS = ("observaciones", "eval_estructural", "eval_otra", "eval_geotecnica", "observaciones_generales")
COLLAPSE = "5.1 colapso total [AIS Tabla 3-2]"
CLASSES = {"inmediata": "demolicion_inmediata", "prioritaria": "demolicion_prioritaria", "probable": "demolicion_probable"}


def answer(df: DataFrame, name: str) -> Column:
    """An answer of the form in lower case; empty where the column is missing or null."""
    if name not in df.columns:
        return F.lit("")
    s = F.lower(F.trim(F.coalesce(F.col(name).cast("string"), F.lit(""))))
    return F.when(s.isin("nan", "none"), "").otherwise(s)


def _grade(table: dict[str, float], c: Column) -> Column:
    out = F.lit(0.0)
    for word, worth in table.items():
        out = F.when(c == word, worth).otherwise(out)
    return out


def form_points(df: DataFrame) -> list[tuple[Column, Column]]:
    """(points, reason or null) of each part of the form, in its order."""
    yes = lambda name: answer(df, name) == "si"
    damage, walls = _grade(GRADES, answer(df, "danos_estructura")), _grade(GRADES, answer(df, "danos_contrapiso_entrepiso_muroscont"))
    severity = F.greatest(_grade(SEVERITY, answer(df, "severidad_danos")), _grade(SEVERITY, answer(df, "severidad_danos_calc")))
    plain = lambda test, points, reason: (F.when(test, float(points)).otherwise(0.0), F.when(test, reason))
    return [
        plain(yes("colapso_parcial"), 25, "5.2 colapso parcial [AIS Tabla 3-2]"),
        (20 * damage, F.when(damage > 0, F.concat(F.lit("5.7 dano estructural "), answer(df, "danos_estructura"), F.lit(" [AIS Tabla 3-13]")))),
        (15 * severity, F.when(severity >= 0.6, "6.2 severidad alta [AIS Tabla 3-13]")),
        plain(yes("inclinacion_importante"), 12, "5.4 inclinacion importante [AIS Tabla 3-2]"),
        plain(yes("asentamiento_severo"), 10, "5.3 asentamiento severo [AIS Tabla 3-3]"),
        (8 * walls, F.when(walls == 1.0, "5.8 dano severo contrapiso/entrepiso/muros contencion [AIS Tabla 3-11]")),
        plain(answer(df, "estado_edificacion") == "malo", 5, "3.8 estado malo [NSR-10 A.10.4.3.4]"),
        (F.when(answer(df, "criterio_habitabilidad") == "i3", 5.0).otherwise(0.0), F.lit(None).cast("string")),
    ]


def evaluated(df: DataFrame, told: DataFrame, key: str) -> DataFrame:
    """df's rows that the form calls unsafe or collapsed, with mention, base, score, motivos and hallazgos_texto.

    told: what findings() tells of the texts (key, gravity, findings, actions). The base leaves out what the texts and the
    recommendation add; both are rounded half to even. A demolition that a text asks for counts only with a finding, a partial
    collapse or severe damage beside it.
    """
    rows = df.join(told, key, "left")
    collapse, habitable = answer(df, "colapso_total") == "si", answer(df, "criterio_habitabilidad")
    parts = form_points(df)
    points = sum((p for p, _ in parts), F.lit(0.0))
    found, none = F.col("findings"), F.array().cast("array<string>")
    asked = F.array_contains(F.transform(F.split(answer(df, "recomendaciones"), ","), lambda t: F.trim(t)), "demoler")
    backed = (F.size(found) > 0) | (answer(df, "colapso_parcial") == "si") | (answer(df, "danos_estructura") == "severo")
    written = F.array_contains("actions", "demoler") & backed
    gravity = F.coalesce("gravity", F.lit(0.0))
    named = lambda f: F.concat(f["patologia"], F.when(f["elemento"].isNull(), "").otherwise(F.concat(F.lit("@"), f["elemento"])))
    reasons = F.array_compact(F.array(
        F.concat(F.lit("7. habitabilidad "), F.upper(habitable), F.lit(" [AIS Tabla 3-22]")), *(r for _, r in parts), F.when(asked, "recomendacion explicita: demoler [AIS Seccion 9]"),
        F.when(written, "texto recomienda demolicion con patologia descrita [AIS pags 27/49]"), F.when(gravity > 0, F.concat(F.lit("patologias en texto: "), F.array_join(F.transform(found, named), ", "))),
    ))
    whole = points + F.when(asked, 20).otherwise(0) + F.when(written, 10).otherwise(0) + 15 * gravity
    cited = F.transform(F.coalesce(found, F.array().cast("array<struct<patologia:string,elemento:string,cita:string>>")), lambda f: F.concat(named(f), F.lit(" ["), f["cita"], F.lit("]")))
    return rows.where(collapse | habitable.isin(*UNSAFE)).withColumns({
        "mention": F.coalesce(asked | written, F.lit(False)), "base": F.when(collapse, 100.0).otherwise(F.bround(points, 0)), "score": F.when(collapse, 100.0).otherwise(F.least(F.lit(100.0), F.bround(whole, 0))).cast("int"),
        "motivos": F.array_join(F.when(collapse, F.array(F.lit(COLLAPSE))).otherwise(F.coalesce(reasons, none)), "; "), "hallazgos_texto": F.array_join(cited, "; "),
    })


def proposals(df: DataFrame, terms, weight, critical, supersede, cited, now: str, key: str = "id_edan", three: DataFrame | None = None, keep: tuple[str, ...] = ()) -> DataFrame:
    """The buildings to propose, by falling score and id, with prioridad from 1.

    three: (edan_id, registros) of inspections that all three sources reach; others are then left out.
    """
    if three is not None:
        df = df.join(three.select(F.col("edan_id").alias("_e"), F.col("registros").alias("_registros")), F.trim(key) == F.col("_e")).drop("_e")
    else:
        df = df.withColumn("_registros", F.lit(""))
    text = F.concat_ws(". ", *(F.coalesce(F.col(c), F.lit("")) if c in df.columns else F.lit("") for c in TEXTS))
    told = findings(df.select(key, text.alias("_text")), key, "_text", terms, weight, critical, supersede, cited)
    rows = evaluated(df, told, key)
    mention, base = F.col("mention"), F.col("base")
    kind = F.when(answer(df, "colapso_total") == "si", CLASSES["inmediata"]).when(mention & (base >= 50), CLASSES["prioritaria"]).when(~mention & (base >= 70), CLASSES["probable"])
    named = rows.withColumn("categoria", kind).where("categoria is not null")
    out = numbered(named.select(key, F.col("_registros").alias("registro_id"), "categoria", "score", "motivos", "hallazgos_texto", *(c for c in keep if c in df.columns)), [-F.col("score"), F.col(key)], "prioridad")
    return out.select(F.col("prioridad").cast("int").alias("prioridad"), *(c for c in out.columns if c != "prioridad"), F.lit(now).alias("fecha_corrida"))


def by_class(proposed: DataFrame) -> DataFrame:
    return proposed.groupBy("categoria").agg(F.count(F.lit(1)).alias("n"))
