from siteweave import shared


def test_tables_that_shrink_in_files_are_not_broadcast(spark):
    # Vectors that repeat take few bytes in a file and 100 MB in a hash relation.
    df = spark.range(200_000).selectExpr("id AS k", "transform(sequence(1, 64), x -> double((x * 37 + id * 7919) % 50)) AS emb")
    plan = lambda d: spark.range(9_000_000).withColumnRenamed("id", "k").join(d.where("k >= 0").select("k", "emb"), "k")._jdf.queryExecution().executedPlan().toString()
    out = shared.written(df, "wide")
    assert shared.COMPRESSED < shared.length(spark, out.written_path) < 10 << 20
    assert "BroadcastHashJoin" in plan(shared.stored(df, "wide"))  # what Spark makes of the bytes
    assert "SortMergeJoin" in plan(out) and "Broadcast" not in plan(out)
    small = shared.written(df.where("k < 10"), "small")
    assert "BroadcastHashJoin" in plan(small) and small.count() == 10
    shared.remove(out)
