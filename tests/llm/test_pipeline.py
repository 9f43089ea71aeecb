import duckdb
import numpy as np
import pytest

import corpus_pipeline
from siteweave.llm import mixing, pii, sentence_pieces, toxicity
from test_set_operators import brute_classes


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    """Each stage's result, written, on the small tables with nulls, repeated ids and empty texts added."""
    at, src = tmp_path_factory.mktemp("corpus"), "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{src}/documents.parquet")
    odd = spark.createDataFrame([(None, None, None, None, None), (900_001, "", "en", None, 0), (900_002, "one", None, "s", 3), (900_003, "one", None, "s", 3)], docs.schema)
    docs.unionByName(odd).write.parquet(f"{at}/documents.parquet")
    spark.read.parquet(f"{src}/labels.parquet").write.parquet(f"{at}/labels.parquet")
    out, docs = [spark.read.parquet(f"{at}/documents.parquet")], None
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, out[-1], str(at)).write.parquet(f"{at}/{name}")
        out.append(spark.read.parquet(f"{at}/{name}"))
    return str(at), out


def rows(df):
    return sorted(map(str, df.collect()))


def test_toxicity_stage_equals_scores_on_the_driver(spark, stages):
    at, (docs, kept, *_) = stages
    model = toxicity.fit_bags(*toxicity.labelled(docs.select("doc_id", "text"), spark.read.parquet(f"{at}/labels.parquet")))
    scorer = toxicity.Scorer(model)
    want = [r for r in docs.collect() if scorer.score([toxicity.folded(r["text"])])[0] < 0.5]
    assert sorted(map(str, want)) == rows(kept) and kept.columns == docs.columns


def test_near_duplicates_stage_equals_brute_force(stages):
    _, (_, before, after, *_) = stages
    want = brute_classes([(r["doc_id"], r["text"]) for r in before.collect()], 5)
    assert sorted(r["doc_id"] for r in after.collect() if r["doc_id"] is not None) == sorted(i for i, (_, c) in want.items() if i == c)
    assert before.where("doc_id is null").count() == after.where("doc_id is null").count()


def test_personal_data_stage_equals_its_parts(spark, stages):
    _, (*_, before, after, _, _) = stages
    alone = pii.pseudonymise(before, pii.configured_key(spark))
    changed = {r["doc_id"] for r in alone.collect() if sum(r[f"n_{k}"] for k in pii.KINDS)}
    old, new = ({r["doc_id"]: r["text"] for r in d.collect()} for d in (before, after))
    assert old.keys() == new.keys() and {i for i in old if old[i] != new[i]} == changed and all(r["n_chars"] == len(r["text"]) for r in after.collect() if r["text"] is not None)


def test_mix_stage_equals_sql(stages):
    at, (_, _, _, before, after, _) = stages
    con = duckdb.connect()
    con.sql(f"CREATE VIEW documents AS SELECT * FROM '{at}/personal_data/*.parquet'")
    want = {d: t // n for d, _, n, _, _, t in con.sql(mixing.OP6_SQL).fetchall() if n}
    got = {r["doc_id"]: r["count"] for r in after.where("length(trim(text)) > 0").groupBy("doc_id").count().collect()}
    assert got == {d: k for d, k in want.items() if k}
    assert before.count() > 0 and after.columns == before.columns


def test_pieces_stage_equals_the_model(stages):
    _, (*_, before, after) = stages
    sp = sentence_pieces.Model(sentence_pieces.model_path())
    texts = {r["doc_id"]: r["text"] for r in before.collect()}
    for r in after.limit(40).collect():
        ways = sp.nbest(texts[r["doc_id"]] or "", sentence_pieces.SEGMENTATIONS)
        assert r["n_tokens"] == len(ways[0][1]) // 4 and np.allclose(r["scores"], [s for s, _ in ways]) and r["round_trip"]
    assert after.count() == before.count()


def test_run_chains_the_stages(spark, stages):
    at, out = stages
    assert rows(corpus_pipeline.run(spark, at).select("doc_id", "n_tokens", "ids_crc32")) == rows(out[-1].select("doc_id", "n_tokens", "ids_crc32"))


def test_empty_tables_pass_through(spark, stages, tmp_path):
    at, (docs, *_) = stages
    spark.read.parquet(f"{at}/labels.parquet").limit(0).write.parquet(f"{tmp_path}/labels.parquet")
    docs.limit(0).write.parquet(f"{tmp_path}/documents.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
