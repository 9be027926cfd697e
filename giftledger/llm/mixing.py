"""Mixing sources to target weights: token totals per source, repetition rates, hash-seeded copies.

Everything is DataFrame code. Sources, in code-point order with null last, take the given weights in turn and share
``share`` times all tokens. A target stops at ``limit`` times its source's tokens and the excess is shared again by
weight until no target is above. A document is then taken floor(rate) times, and once more when its own draw is below
the fraction. The draw is a hash of the id and the text, so reruns and lost executors change nothing. The n rows that
repeat an id, source and text are numbered and have draws 1/n apart, so that together they get n times the fraction.

Defined results: a null or empty text has size 0 and may still be copied (0 tokens); a null source is a source of its
own; which of the rows that repeat id, source and text get a copy more is arbitrary where their other columns differ,
how many is not; an empty table gives no rows. A source without tokens has target 0.

The ranking and the levelling run over one row for each source, which is as long as the list of weights an operator of
a mix keeps, and not as long as the data. Documents meet the targets in a join that Spark broadcasts only when the
stored table of targets is small enough; otherwise adaptive execution splits a hot source.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import WORD, Steps, read, text_key

WEIGHTS, SHARE, LIMIT = (3, 1, 2), 1.5, 2.0


def size_of(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def draw_of(doc_id: Column, text: Column) -> Column:
    """A number in [0, 1) with 52 bits, fixed by the id and the text."""
    seed = F.concat_ws(":", F.coalesce(doc_id.cast("string"), F.lit("")), text_key(text))
    return F.conv(F.substring(F.md5(seed), 1, 13), 16, 10).cast("double") / F.lit(float(2**52))


SAME = ("doc_id", "source", "key")


def sized(docs: DataFrame, *more: Column) -> DataFrame:
    """doc_id, source, size, text key and draw of each row."""
    text = F.col("text").cast("string")
    return docs.select("doc_id", F.col("source").cast("string").alias("source"), size_of(text).alias("size"),
                       text_key(text).alias("key"), draw_of(F.col("doc_id"), text).alias("draw"), *more)


def _matching(rows: DataFrame, found: DataFrame, how: str, *more: str) -> DataFrame:
    """Join on the columns of a repeat, null equal to null."""
    left, right = rows.alias("l"), found.alias("r")
    on = [F.col(f"l.{c}").eqNullSafe(F.col(f"r.{c}")) for c in (*SAME, *more)]
    joined = left.join(right, on, how)
    return joined if how == "left_anti" else joined.select("l.*", *[f"r.{c}" for c in found.columns if c not in (*SAME, *more)])


def with_own_draws(rows: DataFrame, steps: Steps) -> DataFrame:
    """Rows of `sized` where each repeat has a draw of its own.

    Repeats are counted first, combined on the map side. Only their rows are numbered: within each partition of the
    table, and from the counts of the partitions before, so that the repeats of one document are never in one task.
    """
    repeats = steps.keep(rows.groupBy(*SAME).agg(F.count("*").alias("n")).where("n > 1"), "repeats")
    if repeats.isEmpty():
        return rows
    marked = steps.keep(_matching(rows.withColumn("part", F.spark_partition_id()), repeats, "inner"), "repeated")
    counts = marked.groupBy(*SAME, "part").agg(F.count("*").alias("here"))
    earlier = Window.partitionBy(*SAME).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.select(*SAME, "part", F.coalesce(F.sum("here").over(earlier), F.lit(0)).alias("earlier"))
    within = F.row_number().over(Window.partitionBy(*SAME, "part").orderBy("size")) - 1
    numbered = _matching(marked.withColumn("within", within), counts, "inner", "part")
    spread = F.col("draw") + (F.col("earlier") + F.col("within")) / F.col("n")
    own = numbered.withColumn("draw", spread - F.floor(spread)).select(*rows.columns)
    return _matching(rows, repeats, "left_anti").unionByName(own)


def source_targets(sizes: DataFrame, weights=WEIGHTS, share: float = SHARE, limit: float = LIMIT) -> DataFrame:
    """source, source_size and target.

    Filling to a common level: with the sources in order of limit per weight, the level is the largest of
    (wanted - limits of the sources before) / (weights from here on).
    """
    totals = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    in_order = Window.orderBy(F.col("source").isNull(), "source")
    turn = (F.row_number().over(in_order) - 1) % len(weights)
    weighted = totals.withColumn("w", F.element_at(F.array(*[F.lit(float(w)) for w in weights]), turn + 1))
    weighted = weighted.withColumn("most", F.col("source_size") * F.lit(float(limit)))
    by_ratio = Window.orderBy(F.col("most") / F.col("w"), F.col("source").isNull(), "source")
    before = F.coalesce(F.sum("most").over(by_ratio.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))
    rest = F.sum("w").over(by_ratio.rowsBetween(0, Window.unboundedFollowing))
    everything = by_ratio.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    wanted = F.least(F.sum("source_size").over(everything) * F.lit(float(share)), F.sum("most").over(everything))
    levels = weighted.withColumn("level", (wanted - before) / rest)
    level = F.max("level").over(everything)
    return levels.select("source", "source_size", F.least(F.col("most"), F.col("w") * level).alias("target"))


def copies_of() -> Column:
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    whole = F.floor(rate)
    return (whole + (F.col("draw") < rate - whole).cast("long")).cast("long")


def mix(sizes: DataFrame, targets: DataFrame) -> DataFrame:
    """doc_id, source, size, source_size, target, copies and taken of each row of `sized`."""
    left, right = sizes.alias("d"), targets.alias("t")
    joined = left.join(right, F.col("d.source").eqNullSafe(F.col("t.source")))
    counted = joined.select("d.doc_id", "d.source", "d.size", "d.draw", "t.source_size", "t.target")
    counted = counted.withColumn("copies", copies_of())
    return counted.select("doc_id", "source", "size", "source_size", "target", "copies",
                          (F.col("size") * F.col("copies")).alias("taken"))


def mixed_documents(docs: DataFrame, weights=WEIGHTS, share: float = SHARE, limit: float = LIMIT) -> DataFrame:
    """The mix itself: every row of ``docs`` with all its columns, as often as it is taken."""
    steps = Steps(docs.sparkSession, "mixed")
    targets = steps.keep(source_targets(sized(docs), weights, share, limit), "targets")
    rows = with_own_draws(sized(docs, F.struct("*").alias("row")), steps).alias("d")
    met = rows.join(targets.alias("t"), F.col("d.source").eqNullSafe(F.col("t.source")))
    met = met.select("row", "draw", "source_size", "target").withColumn("n", copies_of())
    return met.where("n > 0").select(F.explode(F.array_repeat("row", F.col("n").cast("int"))).alias("row")).select("row.*")


def mix_report(docs: DataFrame, weights=WEIGHTS, share: float = SHARE, limit: float = LIMIT) -> DataFrame:
    """`mix` over whole documents; the texts are read once."""
    steps = Steps(docs.sparkSession, "mix")
    sizes = steps.keep(sized(docs), "sizes")
    targets = steps.keep(source_targets(sizes, weights, share, limit), "targets")
    return mix(with_own_draws(sizes, steps), targets)


def op1_mix_sources(spark, sf_dir):
    return mix_report(read(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


OP1_SQL = """
WITH drawn AS (
  SELECT doc_id, source,
         CAST(coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0) AS BIGINT) AS size,
         CAST(('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), '') || ':' || md5(coalesce(text, ''))), 1, 13)) AS BIGINT)
           / 4503599627370496.0::DOUBLE AS first_draw,
         row_number() OVER (PARTITION BY doc_id, source, text) - 1 AS number, count(*) OVER (PARTITION BY doc_id, source, text) AS repeats
  FROM documents),
sizes AS (
  SELECT doc_id, source, size, CASE WHEN repeats = 1 THEN first_draw
           ELSE first_draw + number / repeats::DOUBLE - floor(first_draw + number / repeats::DOUBLE) END AS draw
  FROM drawn),
totals AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM sizes GROUP BY source),
weighted AS (
  SELECT *, CASE (row_number() OVER (ORDER BY source IS NULL, source) - 1) % 3 WHEN 0 THEN 3.0 WHEN 1 THEN 1.0 ELSE 2.0 END::DOUBLE AS w,
         source_size * 2.0::DOUBLE AS most
  FROM totals),
levels AS (
  SELECT *, ((SELECT sum(source_size) * 1.5::DOUBLE FROM totals)
             - coalesce(sum(most) OVER (ORDER BY most / w, source IS NULL, source ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
            / sum(w) OVER (ORDER BY most / w, source IS NULL, source ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
  FROM weighted),
targets AS (SELECT source, source_size, least(most, w * max(level) OVER ()) AS target FROM levels),
rates AS (
  SELECT doc_id, size, source_size, target, draw,
         CASE WHEN source_size > 0 THEN target / source_size ELSE 0 END AS rate
  FROM sizes JOIN targets ON sizes.source IS NOT DISTINCT FROM targets.source)
SELECT doc_id, size, source_size, target,
       CAST(size * (floor(rate) + CASE WHEN draw < rate - floor(rate) THEN 1 ELSE 0 END) AS BIGINT) AS taken
FROM rates
"""
