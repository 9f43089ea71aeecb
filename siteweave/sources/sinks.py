"""Guarded writers: pinned targets, appended run records, idempotent upserts."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from siteweave.operators.order import numbered
from siteweave.shared import written

CELL = 50_000


class TargetError(RuntimeError):
    """The target is not the one that was pinned, or there is nothing to write."""


def cell(c: Column, kind: str) -> Column:
    """A value as a published cell: empty for null, six decimals, bounded text."""
    value = F.round(c, 6).cast("string") if kind in ("double", "float") else F.substring(c.cast("string"), 1, CELL)
    return F.coalesce(value, F.lit(""))


def cells(df: DataFrame) -> DataFrame:
    return df.select(*(cell(F.col(c), t).alias(c) for c, t in df.dtypes))


def overwrite(df: DataFrame, path: str, pinned: str, allow_empty: bool = False) -> None:
    """Replace a table only if its path is the pinned one and there are rows to write."""
    if path != pinned:
        raise TargetError(f"{path} is not the pinned target {pinned}")
    if not allow_empty and df.isEmpty():
        raise TargetError("nothing to write; the table stays as it is")
    df.write.mode("overwrite").parquet(path)


def row_chars(df: DataFrame) -> Column:
    """Characters of a row as it is sent: its values and a separator for each."""
    return sum((F.length(F.coalesce(F.col(c).cast("string"), F.lit(""))) for c in df.columns), F.lit(len(df.columns)))


def chunks(df: DataFrame, order: str, most: int = 1_500_000, per_task: int = 16) -> DataFrame:
    """df with `chunk`, numbered from 0 in order (which must be total): a chunk takes rows as long as it stays within `most`
    characters, and one row at least.

    Rows are dealt to ranges of about per_task chunks. Each range tells, for every row with which a chunk may begin that comes
    into it from before, where the chunks from there on leave the range and how many they are. These links between ranges are
    followed by doubling from the first row, and each range is then cut from the row where a chunk really begins.
    """
    sized = df.withColumn("_size", row_chars(df).cast("long"))
    total = sized.agg(F.coalesce(F.sum("_size"), F.lit(0))).head()[0]
    if not total:
        return df.withColumn("chunk", F.lit(0).cast("long"))
    n = max(1, -(-total // (most * per_task)))
    rows = written(sized.repartitionByRange(n, F.col(order)).withColumn("_range", F.spark_partition_id()), "ranges")
    totals = rows.groupBy("_range").agg(F.sum("_size").alias("_t"))
    before = F.coalesce(F.sum("_t").over(Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))  # a row for each range
    starts = written(totals.select("_range", before.cast("long").alias("_lo"), (before + F.col("_t")).cast("long").alias("_hi")), "starts")
    placed = rows.select("_range", order, "_size").join(starts, "_range")

    def leave(x: pa.Table) -> pa.Table:
        """(range, at, to, n): chunks that begin at a row, by the characters before it, leave the range at `to`, after n chunks."""
        upto, at, to, count = _cuts(_sorted(x, order), most)
        lo = x.column("_lo")[0].as_py()
        entry = np.flatnonzero(at < lo + most)
        return pa.table({"range": pa.array([x.column("_range")[0].as_py()] * len(entry), pa.int32()), "at": at[entry], "to": to[entry], "n": count[entry]})

    exits = written(placed.groupBy("_range").applyInArrow(leave, "range int, at long, to long, n long"), "exits")
    # The range that holds the character behind which a chunk ends: ranges are looked up by cells of their length, then the row.
    cell = most * per_task
    holds = starts.withColumn("cell", F.explode(F.sequence(F.floor(F.col("_lo") / cell), F.floor((F.col("_hi") - 1) / cell))))
    aims = exits.withColumn("cell", F.floor(F.col("to") / cell)).join(holds, "cell").where("to >= _lo and to < _hi").select("at", "n", "to", F.col("_range").alias("range"))

    def land(x: pa.Table, y: pa.Table) -> pa.Table:
        if not x.num_rows or not y.num_rows:
            return pa.table({c: pa.array([], pa.int64()) for c in ("at", "next", "n")})
        rows = np.sort(y.column("row").to_numpy())
        return pa.table({"at": x.column("at"), "next": rows[np.searchsorted(rows, x.column("to").to_numpy(), side="right") - 1], "n": x.column("n")})

    jump = written(aims.groupBy("range").cogroup(exits.select("range", "at").toDF("range", "row").groupBy("range")).applyInArrow(land, "at long, next long, n long"), "links")
    reached = written(df.sparkSession.createDataFrame([(0, 0)], "at long, base long"), "reached")
    while True:
        more = reached.join(jump, "at").select(F.col("next").alias("at"), (F.col("base") + F.col("n")).alias("base"))
        now = written(reached.unionByName(more).distinct(), "reached")
        further = jump.join(jump.select(F.col("at").alias("next"), F.col("next").alias("_then"), F.col("n").alias("_n")), "next").select("at", F.col("_then").alias("next"), (F.col("n") + F.col("_n")).alias("n"))
        reached, jump = now, written(further, "links")
        if not jump.take(1):
            break
    entered = reached.join(exits, "at").select("range", "at", "base", "n")
    first = entered.select(F.col("range").alias("_range"), F.col("at").alias("_at"), F.col("base").alias("_base"))
    # A range in which no chunk begins, and the rows before a range's first beginning, belong to the chunk before.
    last = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)  # a row for each range
    known = starts.join(first, "_range", "left").join(entered.select(F.col("range").alias("_range"), (F.col("base") + F.col("n") - 1).alias("_end")), "_range", "left")
    known = known.withColumn("_open", F.last("_end", ignorenulls=True).over(last)).select("_range", "_lo", "_at", "_base", "_open")
    columns = df.columns
    fields = T.StructType([*df.schema.fields, T.StructField("chunk", T.LongType())])

    def number(x: pa.Table) -> pa.Table:
        x = _sorted(x, order)
        at, base, open_ = (x.column(c)[0].as_py() for c in ("_at", "_base", "_open"))
        upto, begins, *_ = _cuts(x, most)
        chunk = np.full(len(upto), open_ if open_ is not None else 0, np.int64)
        if at is not None:
            k, chunk_at = int(np.searchsorted(begins, at)), base
            while k < len(upto):
                stop = max(k + 1, int(np.searchsorted(upto, begins[k] + most, side="right")))
                chunk[k:stop] = chunk_at
                k, chunk_at = stop, chunk_at + 1
        return x.select(columns).append_column("chunk", pa.array(chunk))

    return rows.join(known, "_range").groupBy("_range").applyInArrow(number, fields)


def _sorted(x: pa.Table, order: str) -> pa.Table:
    return x.take(pc.sort_indices(x, sort_keys=[(order, "ascending")], null_placement="at_start"))


def _cuts(x: pa.Table, most: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """For the rows of a range in order: characters up to each, characters before it, and for chunks that begin with it, where they
    leave the range and how many they are."""
    size = x.column("_size").to_numpy().astype(np.int64)
    upto = x.column("_lo")[0].as_py() + np.cumsum(size)
    at = upto - size
    after = np.maximum(np.searchsorted(upto, at + most, side="right"), np.arange(len(size)) + 1)
    to, count = np.maximum(at + most, upto), np.ones(len(size), np.int64)
    for k in range(len(size) - 1, -1, -1):
        if (j := after[k]) < len(size):
            to[k], count[k] = to[j], count[j] + 1
    return upto, at, to, count


def padded(df: DataFrame, order: str, rows: int, more: int) -> DataFrame:
    """The cells of df, numbered by `_row`, grown to `rows` rows and `more` further columns of blanks, so that writing them covers
    what the target held before."""
    have = numbered(cells(df), [F.col(order)], "_row")
    have = have.select("_row", *df.columns, *(F.lit("").alias(f"_blank{k}") for k in range(more)))
    first = have.agg(F.count(F.lit(1)).alias("n"))  # one row
    blank = df.sparkSession.range(1, rows + 1).withColumnRenamed("id", "_row").crossJoin(F.broadcast(first)).where("_row > n")
    return have.unionByName(blank.select("_row", *(F.lit("").alias(c) for c in have.columns if c != "_row")))


def append_run(spark: SparkSession, record: dict, path: str) -> None:
    """One run's record at the end of a JSON log."""
    spark.createDataFrame([{k: str(v) for k, v in record.items()}]).coalesce(1).write.mode("append").json(path)


def read_runs(spark: SparkSession, path: str, last: int, schema: str) -> DataFrame:
    """The last records by ts, oldest first; damaged lines are skipped."""
    runs = spark.read.schema(schema).option("mode", "DROPMALFORMED").json(path)
    return runs.orderBy(F.desc("ts")).limit(last).orderBy("ts")


def upsert(current: DataFrame, new: DataFrame, key: str) -> DataFrame:
    """current with the rows of new: their columns replace those of the same key, foreign columns stay."""
    fresh = new.select(F.col(key).alias("_k"), *(F.col(c).alias(f"_{c}") for c in new.columns if c != key))
    both = current.join(fresh, current[key] == fresh["_k"], "full_outer")
    hit = F.col("_k").isNotNull()
    cols = [F.coalesce(F.col("_k"), current[key]).alias(key)]
    cols += [F.when(hit, F.col(f"_{c}")).otherwise(current[c]).alias(c) if c in new.columns else current[c].alias(c) for c in current.columns if c != key]
    return both.select(*cols, *(F.col(f"_{c}").alias(c) for c in new.columns if c not in current.columns))


def fill_missing_ids(current: DataFrame, run: DataFrame, key: str, column: str) -> DataFrame:
    """Blank ids filled from a run; a run's id that the table would lack is an error."""
    out = current.join(run.select(key, F.col(column).alias("_new")), key, "left").withColumn(column, F.when(F.trim(F.coalesce(F.col(column), F.lit(""))) == "", F.col("_new")).otherwise(F.col(column))).drop("_new")
    if not run.join(out.select(column), column, "left_anti").isEmpty():
        raise TargetError("ids of the run are missing from the table")
    return out
