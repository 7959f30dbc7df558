"""Exact percentiles by ranks: histograms that are refined around the wanted ranks, so that no task holds the values of a group."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from ..scratch import removed, scratch_path

SMALL = 1 << 16  # values that may be held
BINS = 256
FEW = 100_000  # rows that may be broadcast


def exact_percentiles(df: DataFrame, by: Sequence[str], value: Column | str, percentiles: Mapping[str, float], small: int = SMALL, bins: int = BINS) -> DataFrame:
    """``by``, one column a percentile (linear between neighbours, as ``percentile``), ``n``; a group for each that has a value that is no null and no NaN.

    Groups of at most ``small`` values are sorted. Of larger ones, at most one in ``small`` rows, values between the least and greatest are
    counted in ``bins`` bins; of the bin that holds a wanted rank the true bounds are taken, and so on until it holds one value, or no more than
    ``small``. Each round reads the values once, and only those between the bounds are counted. Without ``by`` all is one group, and an empty
    table gives one row of nulls.
    """
    spark, made = df.sparkSession, []

    def kept(rows: DataFrame, name: str) -> DataFrame:
        made.append(scratch_path(spark, name))
        rows.write.parquet(made[-1])
        return spark.read.schema(rows.schema).parquet(made[-1])

    v = (F.col(value) if isinstance(value, str) else value).cast("double")
    key = F.struct(*[F.col(c) for c in by]) if by else F.struct(F.lit(0).alias("_all"))
    values = kept(df.select(key.alias("key"), v.alias("v")).where("v is not null and not isnan(v)"), "values")
    groups = kept(values.groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.min("v").alias("lo"), F.max("v").alias("hi")), "groups")
    large = groups.where(F.col("n") > small)
    n_large = large.count()
    with_ = lambda rows, table, how="inner": rows.join(F.broadcast(table) if n_large <= FEW else table, "key", how)
    little = with_(values, large.select("key"), "left_anti").groupBy("key").agg(F.count(F.lit(1)).alias("n"), *[F.percentile("v", p).alias(c) for c, p in percentiles.items()])
    ends = {p: (F.floor(p * (F.col("n") - 1)), F.ceil(p * (F.col("n") - 1))) for p in percentiles.values()}
    ranks = F.array_distinct(F.array(*[e for pair in ends.values() for e in pair]))
    targets = large.select("key", F.explode(ranks).alias("rank"), "lo", "hi", F.col("n").alias("inside"), F.lit(0).cast("long").alias("below"))
    if not n_large:
        return _by(little, by, percentiles, spark)
    targets = kept(targets, "targets")
    while not targets.where((F.col("lo") < F.col("hi")) & (F.col("inside") > small)).isEmpty():
        open_ = targets.where((F.col("lo") < F.col("hi")) & (F.col("inside") > small))
        met = with_(values, open_).where("v >= lo and v <= hi")
        bin_ = F.least(F.floor((F.col("v") / 2 - F.col("lo") / 2) / (F.col("hi") / 2 - F.col("lo") / 2) * bins), F.lit(bins - 1))
        counted = met.groupBy("key", "rank", "below", bin_.alias("bin")).agg(F.count(F.lit(1)).alias("c"), F.min("v").alias("lo"), F.max("v").alias("hi"))
        upto = counted.withColumn("upto", F.col("below") + F.sum("c").over(W.partitionBy("key", "rank").orderBy("bin")))
        held = upto.where((F.col("rank") < F.col("upto")) & (F.col("rank") >= F.col("upto") - F.col("c")))
        new = held.select("key", "rank", "lo", "hi", F.col("c").alias("inside"), (F.col("upto") - F.col("c")).alias("below"))
        targets = kept(targets.where((F.col("lo") >= F.col("hi")) | (F.col("inside") <= small)).unionByName(new), "targets")
    one = targets.where("lo >= hi").select("key", "rank", F.col("lo").alias("v"))
    few = with_(values, targets.where("lo < hi")).where("v >= lo and v <= hi").groupBy("key", "rank", "below").agg(F.sort_array(F.collect_list("v")).alias("vs"))  # ``small`` at most
    found = one.unionByName(few.select("key", "rank", F.element_at("vs", (F.col("rank") - F.col("below") + 1).cast("int")).alias("v")))
    told = found.groupBy("key").agg(F.map_from_entries(F.collect_list(F.struct("rank", "v"))).alias("at")).join(large.select("key", "n"), "key")
    at, place = (lambda e: F.col("at")[e]), (lambda p: p * (F.col("n") - 1))
    between = lambda p: F.when(ends[p][0] == ends[p][1], at(ends[p][0])).otherwise((ends[p][1] - place(p)) * at(ends[p][0]) + (place(p) - ends[p][0]) * at(ends[p][1]))
    done = told.select("key", "n", *[between(p).alias(c) for c, p in percentiles.items()])
    out = kept(little.unionByName(done), "percentiles")
    for path in made[:-1]:
        removed(spark, path)
    return _by(out, by, percentiles, spark)


def _by(out: DataFrame, by: Sequence[str], percentiles: Mapping[str, float], spark: SparkSession) -> DataFrame:
    if by:
        return out.select("key.*", *percentiles, "n")
    none = spark.range(1).join(out, F.lit(True), "left")  # one group at most
    return none.select(*percentiles, F.coalesce("n", F.lit(0).cast("long")).alias("n"))
