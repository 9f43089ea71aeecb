"""What several steps read is made once: plans that follow hold none of the work before it."""

from pyspark.sql import functions as F

from siteweave.functions import text
from siteweave.operators import linkage, reports
from siteweave.plans import linkage as queries
from siteweave.sources import tables

SMALL = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_matches_are_made_once(spark):
    m, v, e = queries.matched(spark, SMALL)
    assert plan(m).count("Join ") <= 3
    assert m.count() == v.count() == m.select("visita_id").distinct().count()


def test_trust_keeps_every_match(spark):
    v, e = queries.both(spark, SMALL)
    rows = [("V1", "S1", "geo", 1.0), ("V2", None, None, None), ("V3", "gone", "geo", 2.0), ("gone", "S1", "geo", 3.0), (None, None, None, None)]
    m = spark.createDataFrame(rows, "visita_id string, sitio_id string, match_method string, match_score double")
    got = {(r["visita_id"], r["sitio_id"]): (r["match_score"], r["trust"] is not None) for r in linkage.trust(m, v, e).collect()}
    assert got == {("V1", "S1"): (1.0, True), ("V2", None): (None, False), ("V3", "gone"): (2.0, False), ("gone", "S1"): (3.0, False), (None, None): (None, False)}


def test_parsing_is_dealt_to_tasks_by_rows(spark, monkeypatch):
    monkeypatch.setattr(tables, "SPREAD", 100)
    few, many = tables.visits(spark, SMALL), tables.visits(spark, SMALL, spread=True)
    assert many.rdd.getNumPartitions() == 15 and many.exceptAll(few).isEmpty() and few.exceptAll(many).isEmpty()


def test_survey_parses_addresses_once(spark, monkeypatch):
    survey = spark.createDataFrame([(0, "g1", 3.40, -76.50, "CL 1 # 2-3", "f", "e")], "pos long, gid string, rlat double, rlon double, rkey string, fecha string, evaluador string")
    critical = spark.createDataFrame([("C", "", "3.300000, -76.400000", "Calle 1 No. 2-3, Cali")], "registro_id string, sitio_id string, coords_unificadas string, direccion_unificada string")
    asked, search = [], reports.by_address
    monkeypatch.setattr(reports, "by_address", lambda records, *more: asked.append(plan(records)) or search(records, *more))
    assert reports.survey_rollup(reports.survey_cross(critical, survey)).head()["n_levantados"] == 1
    assert len(asked) == 1 and text._NUMBER_SIGN not in asked[0]


def test_inspections_parse_addresses_once(spark):
    kinds = "registro_id string, sitio_id string, visita_id string, direccion_unificada string, barrio_unificado string, comuna_unificada string, coords_unificadas string, tipo_estructura_edan string, tipo_estructura_visita string"
    r = spark.createDataFrame([("R1", "S1", "V1", "CL 5 # 43A-15, Cali", "El Lido", "", "", "casa", "")], kinds)
    f = spark.createDataFrame([("E1", "CL 5 # 43A-15, Cali", "El Lido", "", "", "casa")], "id_edan string, direccion_norm string, barrio_vereda string, comuna string, coords string, uso_edificacion string")
    seen = []

    def cascade(v, e):
        seen.extend([plan(v), plan(e)])
        return linkage.cascade(v, e, tiers=("handshake",))

    assert [x["edan_id"] for x in reports.inspection_cascade(r, f, cascade, linkage.prepare).collect()] == ["E1"]
    assert not any("APARTAMENTO" in p for p in seen)


def test_only_the_embedding_tier_takes_embeddings_along(spark, monkeypatch):
    v, e = queries.both(spark, SMALL)
    emb = F.array(*(F.lit(float(k)) for k in range(4)))
    v, e = v.withColumn("emb", emb), e.withColumn("emb", emb)
    seen = {}

    def watched(name, tier):
        def run(left, *more):
            seen[name] = (left.count(), left.where("emb is not null").count())
            return tier(left, *more)

        return run

    want = {tuple(r) for r in linkage.cascade(v, e).collect()}
    monkeypatch.setattr(linkage, "TIERS", tuple((n, t if n in linkage.CHEAP else watched(n, t)) for n, t in linkage.TIERS))
    assert {tuple(r) for r in linkage.cascade(v, e).collect()} == want
    assert [*seen] == ["tfidf", "fuzzy", "spatial_bridge", "embedding"]
    rows = [n for n, _ in seen.values()]
    assert rows == sorted(rows, reverse=True) and [k for _, k in seen.values()] == [0, 0, 0, rows[-1]]
