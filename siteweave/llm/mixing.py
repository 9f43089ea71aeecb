"""Mixing sources to target weights by weighted fair queueing.

Each document, in shuffled order within its source, gets a virtual finish time: the source's words up to its end, over
the source's target. Copies of a source that is to be repeated follow on as further rounds of the same order. All copies
are range-sorted by finish time and taken from the front until the total budget is used up.

Null texts count 0 words; null sources form one source, the last. Repeated rows are separate documents. A source without
words has target 0 and gives 0. Columns beside the ones named are ignored by plan() and kept by mix(), whose own column
names begin with `mix_`; columns with these names are replaced.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from siteweave.llm.common import pieces, schema_with, table, utf8, word_bounds, written

WEIGHTS = (5.0, 2.0, 1.0)
MOST = 3


def with_words(df: DataFrame, text: str, into: str) -> DataFrame:
    """df without its text, with the number of words [^\\x20\\x09-\\x0D]+ in it."""
    keep = [c for c in df.columns if c not in (text, into)]
    schema = schema_with(df.select(*keep), **{into: "long"})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, text, 4 << 20):
            words = word_bounds(*utf8(batch.column(text)))[2]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in keep), pa.array(words, pa.int64())], names=[*keep, into])

    return df.select(*keep, text).mapInArrow(run, schema)


def targets(sized: DataFrame, source: str, size: str, weights: tuple[float, ...] = WEIGHTS, most: int = MOST) -> DataFrame:
    """One row for each source: its size and its target, the budget being the size of all sources.

    Filling up to caps of `most` times the size has a closed form: in ascending order of size over weight, sources are
    at their cap as long as the cap is no more than their share of what the sources before them leave. The windows run
    over one row for each source.
    """
    by = sized.groupBy(source).agg(F.sum(size).alias("source_size"))
    rank = Window.orderBy(F.col(source).asc_nulls_last())
    weight = F.element_at(F.array(*(F.lit(w) for w in weights)), ((F.row_number().over(rank) - 1) % len(weights) + 1).cast("int"))
    every = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    ranked = by.withColumn("w", F.when(F.col("source_size") > 0, weight).otherwise(F.lit(0.0)))
    order = Window.orderBy(F.when(F.col("w") > 0, F.col("source_size") / F.col("w")).otherwise(-1.0), F.col(source).asc_nulls_last())
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    after = order.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    cap = F.lit(most) * F.col("source_size")
    filled = (
        ranked.withColumn("budget", F.sum("source_size").over(every))
        .withColumn("left", F.col("budget") - F.coalesce(F.sum(cap).over(before), F.lit(0)))
        .withColumn("weights", F.sum("w").over(after))
        .withColumn("open", F.when((F.col("w") > 0) & (cap * F.col("weights") > F.col("left") * F.col("w")), 1).otherwise(0))
    )
    # The sources that are not at their cap share what is left by weight.
    level = F.max(F.when(F.col("open") == 1, F.col("left") / F.col("weights"))).over(every)
    return filled.select(source, "source_size", F.when(F.col("w") == 0, 0.0).when(F.col("open") == 1, F.col("w") * level).otherwise(cap.cast("double")).alias("target"))


def running(df: DataFrame, order: list[Column], value: str, into: str, within: str | None = None) -> DataFrame:
    """df with the sum of `value` up to each row in this order, which must be total; within a column's values, if given.

    Rows are range-partitioned and written; the partitions' sums, one row for each partition and value of `within`, give
    each partition its offset. No task sees more than its range. `within` must lead the order.
    """
    part = "mix_part"
    # Written, so that the ranges are drawn once; the order columns are stored beside the rows.
    named = {f"mix_o{k}": c for k, c in enumerate(order)}
    dealt = written(df.withColumns(named).repartitionByRange(*(F.col(c).asc_nulls_last() for c in named)).withColumn(part, F.spark_partition_id()), "ranges")
    keys = [part, *([within] if within else [])]
    sums = dealt.groupBy(*keys).agg(F.sum(value).alias("mix_sum"))
    ahead = (Window.partitionBy(within) if within else Window.partitionBy()).orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    offsets = sums.withColumn("mix_ahead", F.coalesce(F.sum("mix_sum").over(ahead), F.lit(0))).select(*(F.col(k).alias(f"mix_k_{k}") for k in keys), "mix_ahead")
    upto = Window.partitionBy(*keys).orderBy(*(F.col(c).asc_nulls_last() for c in named)).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    same = [F.col(k).eqNullSafe(F.col(f"mix_k_{k}")) for k in keys]
    out = dealt.withColumn("mix_here", F.sum(value).over(upto)).join(offsets, same)
    return out.withColumn(into, F.col("mix_here") + F.col("mix_ahead")).drop(*named, part, "mix_here", "mix_ahead", *(f"mix_k_{k}" for k in keys))


def _tie(id_column: str, source: str, text: str) -> Column:
    return F.xxhash64(id_column, source, text)


def plan(df: DataFrame, id_column: str, source: str, text: str, seed: int = 0, weights: tuple[float, ...] = WEIGHTS, most: int = MOST) -> DataFrame:
    """For each row of df: mix_id, mix_source, mix_tie (a hash of the row), size, source_size, target and copies, the
    number of times the mix takes the document. Rows that are equal throughout are taken equally often."""
    shuffle = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(id_column).cast("string"), F.lit("null"))))
    rows = df.select(F.col(id_column).alias("mix_id"), F.col(source).alias("mix_source"), shuffle.alias("mix_shuffle"), _tie(id_column, source, text).alias("mix_tie"), F.col(text).alias("mix_text"))
    sized = written(with_words(rows, "mix_text", "size"), "sizes")
    order = [F.col("mix_source"), F.col("mix_shuffle"), F.col("mix_tie"), F.monotonically_increasing_id()]
    goal = targets(sized, "mix_source", "size", weights, most).withColumnRenamed("mix_source", "mix_of")
    cum = running(sized, order, "size", "mix_cum", within="mix_source")
    queued = written(cum.join(goal, F.col("mix_source").eqNullSafe(F.col("mix_of"))).drop("mix_of"), "queue")

    places = ["mix_finish", "mix_last", "mix_source", "mix_shuffle", "mix_tie"]

    def place(k: int) -> Column:
        finish = F.try_divide(F.col("mix_cum") + k * F.col("source_size"), F.col("target"))
        return F.struct(finish.alias("mix_finish"), F.col("mix_source").isNull().alias("mix_last"), "mix_source", "mix_shuffle", "mix_tie")

    copies = queued.where("size > 0").select("size", F.explode(F.array(*(place(k) for k in range(most)))).alias("p")).select("size", "p.*")
    budget = queued.agg(F.sum("size").alias("mix_budget"))
    used = running(copies, [F.col(c) for c in places], "size", "mix_used").crossJoin(F.broadcast(budget))
    # The last place that the budget reaches (one row); a copy is taken if its place is not after it.
    cut = used.where("mix_used <= mix_budget").agg(F.max(F.struct(*places)).alias("mix_cut"))
    taken = sum(((place(k) <= F.col("mix_cut")).cast("int") for k in range(most)), F.lit(0))
    number = F.when(F.col("size") > 0, F.coalesce(taken, F.lit(0))).otherwise(1)
    return queued.crossJoin(F.broadcast(cut)).select("mix_id", "mix_source", "mix_tie", "size", "source_size", "target", number.alias("copies"))


def mix(df: DataFrame, id_column: str = "doc_id", source: str = "source", text: str = "text", **how) -> DataFrame:
    """df's rows as the mix takes them: left out, once or several times. Rows without words stay once."""
    decided = plan(df, id_column, source, text, **how).select("mix_id", F.col("mix_tie").alias("mix_key"), "copies").distinct()
    keyed = df.withColumn("mix_key", _tie(id_column, source, text))
    same = [keyed["mix_key"] == decided["mix_key"], keyed[id_column].eqNullSafe(decided["mix_id"])]
    kept = keyed.join(decided.where("copies > 0"), same)
    return kept.select(*(keyed[c] for c in df.columns if c != "mix_key"), F.explode(F.array_repeat(F.lit(0), F.col("copies").cast("int"))).alias("mix_copy")).drop("mix_copy")


def op6_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    out = plan(docs, "doc_id", "source", "text")
    return out.select(F.col("mix_id").alias("doc_id"), F.col("mix_source").alias("source"), "size", "source_size", "target", (F.col("size") * F.col("copies")).cast("long").alias("taken"))


OP6_SQL = """
WITH d AS (SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS BIGINT) AS size,
                  md5('0:' || coalesce(CAST(doc_id AS VARCHAR), 'null')) AS h FROM documents),
s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY source),
r AS (SELECT *, CASE WHEN source_size > 0 THEN list_extract([5.0::DOUBLE, 2.0::DOUBLE, 1.0::DOUBLE], CAST((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS BIGINT)) ELSE 0.0::DOUBLE END AS w FROM s),
b AS (SELECT *, CASE WHEN w > 0 THEN source_size / w ELSE -1.0 END AS o, CAST(sum(source_size) OVER () AS BIGINT) AS budget FROM r),
f AS (SELECT *, budget - coalesce(CAST(sum(3 * source_size) OVER (ORDER BY o, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS BIGINT), 0) AS room,
             sum(w) OVER (ORDER BY o, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS ws FROM b),
g AS (SELECT *, (w > 0 AND 3 * source_size * ws > room * w) AS is_open FROM f),
l AS (SELECT *, max(CASE WHEN is_open THEN room / ws END) OVER () AS level FROM g),
t AS (SELECT source, source_size, budget, CASE WHEN w = 0 THEN 0.0::DOUBLE WHEN is_open THEN w * level ELSE CAST(3 * source_size AS DOUBLE) END AS target FROM l),
q AS (SELECT d.*, t.source_size, t.target, t.budget,
             CAST(sum(size) OVER (PARTITION BY d.source ORDER BY h ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS cum
      FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source),
c AS (SELECT doc_id, source, h, size, budget, (cum + k * source_size) / target AS fin FROM q, (VALUES (0), (1), (2)) AS e(k) WHERE size > 0),
u AS (SELECT *, sum(size) OVER (ORDER BY fin, source NULLS LAST, h ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS used FROM c),
n AS (SELECT doc_id, source, count(*) AS copies FROM u WHERE used <= budget GROUP BY doc_id, source)
SELECT q.doc_id, q.source, q.size, q.source_size, q.target, CAST(q.size * coalesce(n.copies, 0) AS BIGINT) AS taken
FROM q LEFT JOIN n ON q.doc_id IS NOT DISTINCT FROM n.doc_id AND q.source IS NOT DISTINCT FROM n.source
"""
