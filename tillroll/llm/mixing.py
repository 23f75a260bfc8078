"""Operator 7: mix sources to target weights by weighted fair queueing."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window

from tillroll.llm.ranks import hashed_key, hex_digits, running_sum
from tillroll.llm.tables import WORD, table
from tillroll.operators.lookup import join_lookup
from tillroll.scratch import materialise, working_folder

# Fixed values of the query: the weights that the sources take in turn, and how often a source may repeat.
WEIGHTS = (5, 2, 1)
REPEATS = 3


@dataclass(frozen=True)
class Cut:
    """The first copy that the budget no longer holds; all are taken if ``finish`` is null."""

    finish: float | None
    key: str | None
    epoch: int | None


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(
    sizes: DataFrame, weights: Sequence[int] = WEIGHTS, repeats: int = REPEATS, share: float = 1.0
) -> DataFrame:
    """Targets from ``sizes`` (source, size): columns source, source_number, source_size, weight, target.

    The sources by code point, null last, weigh ``weights`` in turn and divide ``share`` of all sizes. A target
    stops at ``repeats`` times the source's size; the excess goes to the others by weight until none is above.
    One row per source is held; each round of sharing is one sum over them.
    """
    totals = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    order = Window.orderBy(F.col("source").asc_nulls_last())  # one row per source
    turn = F.pmod("source_number", F.lit(len(weights)))
    sources = materialise(totals.withColumn("source_number", F.row_number().over(order) - 1).withColumn(
        "weight", F.element_at(F.array(*map(F.lit, weights)), (turn + 1).cast("int")).cast("long")))
    full = F.col("source_size") * F.lit(repeats)
    budget = sources.agg(F.sum("source_size")).first()[0] or 0
    budget = budget if share == 1.0 else int(budget * share)
    left, heavy, stopped = budget, 0, -1
    capped = F.lit(False)
    while True:
        row = sources.agg(
            F.count_if(capped).alias("stopped"),
            F.coalesce(F.sum(F.when(capped, full)), F.lit(0)).alias("used"),
            F.coalesce(F.sum(F.when(~capped, F.col("weight"))), F.lit(0)).alias("heavy")).first()
        left, heavy = budget - row["used"], row["heavy"]
        if row["stopped"] == stopped or heavy == 0:
            break
        stopped = row["stopped"]
        # full <= left * weight / heavy, in whole numbers
        capped = full * F.lit(heavy) <= F.lit(left) * F.col("weight")
    fair = (F.lit(left) * F.col("weight")).cast("double") / F.lit(float(max(heavy, 1)))
    return sources.withColumn("target", F.when(capped, full.cast("double")).otherwise(fair))


def fair_queue(
    rows: DataFrame, weights: Sequence[int] = WEIGHTS, repeats: int = REPEATS, share: float = 1.0
) -> DataFrame:
    """The mix of ``rows`` (key, source, size): adds source_size, target, finish, copies and taken.

    ``rows`` reads a written table; ``key`` (``hashed_key``) shuffles the documents of a source. The virtual
    finish time of copy ``e`` of a document is (e * source size + sizes up to and with it) / target. The mix
    takes the copies in order of that time, over all sources, up to the budget, the sum of all targets;
    ``copies`` says how many of the document that are, ``taken`` how many words. Rows of equal key and size
    are exchangeable. A null or unknown source is a source. No rows: no rows.
    """
    targets = source_targets(rows.select("source", "size"), weights, repeats, share)
    renamed = targets.withColumnRenamed("source", "__source")
    joined = join_lookup(rows, materialise(renamed), F.col("source").eqNullSafe(F.col("__source")), "inner")
    digits = hex_digits(rows.count())
    queued = materialise(running_sum(
        materialise(joined.drop("__source")), ["source_number"], "key", digits, F.col("size"), "earlier", ["size"]))
    copy = F.explode(F.sequence(F.lit(0), F.lit(repeats - 1)))
    entries = queued.filter("target > 0").select("key", "size", "source_size", "target", "earlier", copy.alias("epoch")).select(
        "key", "size", "epoch", finish_time(F.col("epoch")).alias("finish"))
    cut = _cut(entries, round(targets.agg(F.sum("target")).first()[0] or 0.0), digits)
    copies = sum(
        (F.when(_before(cut, F.col("key"), F.lit(epoch)), 1).otherwise(0) for epoch in range(repeats)), F.lit(0))
    copies = F.when(F.col("target") > 0, copies).otherwise(0)
    return queued.withColumn("finish", finish_time(F.lit(0))).withColumn("copies", copies.cast("int")).withColumn(
        "taken", F.col("copies") * F.col("size"))


def finish_time(epoch: Column) -> Column:
    done = epoch * F.col("source_size") + F.col("earlier") + F.col("size")
    return F.when(F.col("target") > 0, done.cast("double") / F.col("target"))


def _before(cut: Cut, key: Column, epoch: Column) -> Column:
    if cut.finish is None:
        return F.lit(True)
    finish = finish_time(epoch)
    return (finish < cut.finish) | ((finish == cut.finish) & (
        (key < cut.key) | ((key == cut.key) & (epoch < cut.epoch))))


def _cut(entries: DataFrame, budget: int, digits: int) -> Cut:
    """Where the copies, sorted by (finish, key, epoch) over all sources, exceed the budget.

    Within a source finish times are spread evenly, so equal ranges of time hold about equal sizes: they serve
    as the range partitions of the sort. Only sums per range and the copies of one range are looked at.
    """
    ranges = 16 ** digits
    binned = entries.withColumn("__range", F.least(F.floor(F.col("finish") * ranges), F.lit(2 * ranges)))
    sums = binned.groupBy("__range").agg(F.sum("size").alias("__size"))
    upto = F.sum("__size").over(Window.orderBy("__range"))  # one row per range
    over = sums.withColumn("__upto", upto).filter(F.col("__upto") > budget).orderBy("__range").first()
    if over is None:
        return Cut(None, None, None)
    before = over["__upto"] - over["__size"]
    order = Window.orderBy("finish", "key", "epoch", "size")
    within = binned.filter(F.col("__range") == over["__range"]).withColumn("__upto", F.sum("size").over(order) + before)
    first = within.filter(F.col("__upto") > budget).orderBy("finish", "key", "epoch", "size").first()
    return Cut(first["finish"], first["key"], first["epoch"])


def mix(docs: DataFrame, weights: Sequence[int] = WEIGHTS, repeats: int = REPEATS) -> DataFrame:
    """The documents of the mix in their columns, each as often as the mix takes it.

    Sizes are words. Documents with nothing taken go. Rows with equal doc_id, source and text share one decision.
    """
    key = hashed_key(F.col("doc_id"), F.xxhash64("text"))
    rows = materialise(docs.select(key.alias("key"), "source", word_count(F.col("text")).alias("size")))
    taken = fair_queue(rows, weights, repeats).groupBy("key").agg(
        F.max("copies").alias("__copies")).filter("__copies > 0")
    return docs.withColumn("__key", key).join(
        materialise(taken.withColumnRenamed("key", "__key")).hint("merge"), "__key").withColumn(
        "__copy", F.explode(F.sequence(F.lit(1), F.col("__copies")))).select(*docs.columns)


def op7_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    rows = docs.select(
        "doc_id", "source", word_count(F.col("text")).alias("size"),
        F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))).alias("key"))
    return fair_queue(materialise(rows)).select("doc_id", "size", "source_size", "target", "taken")


OP7_SQL = r"""
WITH RECURSIVE rows AS (
  SELECT doc_id, source, md5(coalesce(CAST(doc_id AS VARCHAR), '')) AS key,
    coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS size
  FROM documents),
sources AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
    [5, 2, 1][1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3] AS weight
  FROM rows GROUP BY source),
total AS (SELECT CAST(sum(source_size) AS BIGINT) AS budget FROM sources),
stops AS (
  SELECT 0 AS round, budget AS remaining, (SELECT CAST(sum(weight) AS BIGINT) FROM sources) AS heavy FROM total
  UNION ALL
  SELECT round + 1,
    budget - coalesce((SELECT CAST(sum(3 * s.source_size) AS BIGINT) FROM sources s
                       WHERE 3 * s.source_size * heavy <= remaining * s.weight), 0),
    coalesce((SELECT CAST(sum(s.weight) AS BIGINT) FROM sources s
              WHERE 3 * s.source_size * heavy > remaining * s.weight), 0)
  FROM stops, total WHERE round < 50 AND heavy > 0),
fair AS (SELECT remaining, heavy FROM stops WHERE heavy > 0 ORDER BY round DESC LIMIT 1),
targets AS (
  SELECT s.*, CASE WHEN 3 * source_size * heavy <= remaining * weight THEN CAST(3 * source_size AS DOUBLE)
    ELSE CAST(remaining * weight AS DOUBLE) / CAST(heavy AS DOUBLE) END AS target
  FROM sources s, fair),
queued AS (
  SELECT r.doc_id, r.key, r.size, t.source_size, t.target,
    CAST(sum(r.size) OVER (PARTITION BY r.source ORDER BY r.key, r.size
                           ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS upto
  FROM rows r JOIN targets t ON r.source IS NOT DISTINCT FROM t.source),
entries AS (
  SELECT q.*, e.epoch, CAST(e.epoch * source_size + upto AS DOUBLE) / target AS finish
  FROM queued q, (SELECT unnest([0, 1, 2]) AS epoch) e WHERE target > 0),
ordered AS (
  SELECT doc_id, key, size,
    sum(size) OVER (ORDER BY finish, key, epoch, size ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS mixed
  FROM entries),
taken AS (
  SELECT key, count(*) AS copies FROM ordered
  WHERE mixed <= (SELECT round(sum(target)) FROM targets) GROUP BY key)
SELECT q.doc_id, CAST(q.size AS BIGINT) AS size, q.source_size, q.target,
  CAST(coalesce(t.copies, 0) * q.size AS BIGINT) AS taken
FROM queued q LEFT JOIN taken t USING (key)
"""
