"""Exact quantiles of any finite doubles, in a bounded number of steps.

Values are counted first; everything after that reads the table of distinct values. Where a key
has many of them, the interval that holds a wanted rank is cut in equal parts again and again, not
by value but by the ordered 64-bit form of a double: its sign, exponent and fraction as one whole
number. An interval of 2^64 such numbers is down to one after seven cuts into 1,024 parts, however
the values lie, from the smallest subnormal to the largest double.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F

from tripgrid.functions.numeric import as_col
from tripgrid.session import scratch_dir

SLOTS = 1024
LARGEST_SLOT = 10_000


def ordered_form(value) -> Column:
    """A long that orders finite doubles as they are; 0.0 and -0.0 have the same one.

    The bits of the absolute value, exponent first, with the value's sign. Powers of two are exact,
    and so are products and quotients with them.
    """
    value = as_col(value)
    size = F.abs(value)
    power = lambda e: F.pow(F.lit(2.0), e)
    guess = F.least(F.greatest(F.floor(F.log2(size)), F.lit(-1022)), F.lit(1023))
    share = size / power(guess)
    # the logarithm may be off by one next to a power of two
    exponent = guess + F.when(share < 1.0, -1).when(share >= 2.0, 1).otherwise(0)
    fraction = share * F.when(share < 1.0, 2.0).when(share >= 2.0, 0.5).otherwise(1.0)
    normal = (exponent + 1023) * F.lit(1 << 52) + ((fraction - 1.0) * float(1 << 52)).cast("long")
    tiny = (size * F.lit(2.0**1000) * F.lit(2.0**74)).cast("long")
    bits = F.when(size < 2.0**-1022, tiny).otherwise(normal)
    return F.when(value < 0, -bits).otherwise(bits)


def exact_quantiles(
    df: DataFrame,
    value: str,
    probabilities: dict[str, float],
    keys: tuple[str, ...] = (),
    slots: int = SLOTS,
    largest: int = LARGEST_SLOT,
) -> DataFrame:
    """Exact interpolated quantiles without gathering a group.

    1. Count rows per distinct value: a value repeated in a third of the data is one row per task
       from here on. The counts are written, as every following step reads them; this is the only
       pass over ``df``.
    2. A key with at most ``largest`` distinct values ranks them.
    3. A key with more cuts the interval around each wanted rank into ``slots`` parts of its
       ordered form, until the part that holds the rank has at most ``largest`` distinct values,
       which are ranked. 64 bits are used up after seven cuts of 1,024 parts.

    The result holds one row per key with the count and one column per probability; rows
    with a missing key are left out, and values that are no finite numbers count as missing.
    ``largest`` is at least 2, as two values can be neighbours in the ordered form.
    """
    if largest < 2 or slots < 2:
        raise ValueError("slots and largest are at least 2")
    counted, distinct = count_values(df, value, tuple(keys))
    return quantiles_of_counts(counted, distinct, probabilities, tuple(keys), slots, largest)


def count_values(df: DataFrame, value: str, keys: tuple[str, ...] = ()) -> tuple[DataFrame, int]:
    """Written table (_key, _v, _n) of rows per key and finite value, and its number of rows."""
    number = F.col(value).cast("double")
    key = F.struct(*keys) if keys else F.struct(F.lit(0).alias("all"))
    counted = (
        df.filter(number.isNotNull() & ~F.isnan(number) & (F.abs(number) < float("inf")))
        .groupBy(*keys, number.alias("_v"))
        .agg(F.count(F.lit(1)).alias("_n"))
        .dropna(subset=list(keys))
        .select(key.alias("_key"), "_v", "_n")
    )
    seen = Observation()
    path = scratch_dir(df.sparkSession, "quantiles")
    counted.observe(seen, F.count(F.lit(1)).alias("n")).write.parquet(path)
    return df.sparkSession.read.schema(counted.schema).parquet(path), seen.get["n"]


def quantiles_of_counts(
    counted: DataFrame, distinct: int, probabilities: dict[str, float], keys: tuple[str, ...], slots: int, largest: int
) -> DataFrame:
    marks = None if distinct <= largest else _intervals(counted, probabilities, slots, largest)
    found = _ranked(counted, probabilities) if marks is None else _ranked_inside(counted, marks)
    at = lambda mark: F.max(F.when(F.col("mark") == mark, F.col("_v")))
    ends = found.groupBy("_key").agg(
        F.max("_total").alias("_total"),
        *[at(f"{n}_{side}").alias(f"_{n}_{side}") for n in probabilities for side in ("lo", "hi")],
    )
    # the difference of two finite doubles may be infinite, so both ends are weighted instead
    weight = lambda p: _position(p) - F.floor(_position(p))
    between = lambda n, p: F.when(F.col(f"_{n}_lo") == F.col(f"_{n}_hi"), F.col(f"_{n}_lo")).otherwise(
        F.when(
            F.abs(F.col(f"_{n}_hi") / 2 - F.col(f"_{n}_lo") / 2) < 2.0**1022,
            F.col(f"_{n}_lo") + (F.col(f"_{n}_hi") - F.col(f"_{n}_lo")) * weight(p),
        ).otherwise(F.col(f"_{n}_lo") * (1.0 - weight(p)) + F.col(f"_{n}_hi") * weight(p))
    )
    return ends.select(
        *[F.col(f"_key.{k}").alias(k) for k in keys], F.col("_total").alias("value_count"),
        *[between(n, p).alias(n) for n, p in probabilities.items()],
    )


def _wanted(probabilities: dict[str, float]) -> Column:
    return F.array(*[
        F.struct(F.lit(f"{name}_{side}").alias("mark"), rank.cast("long").alias("rank"))
        for name, p in probabilities.items()
        for side, rank in (("lo", F.floor(_position(p))), ("hi", F.ceil(_position(p))))
    ])


def _ranked(counted: DataFrame, probabilities: dict[str, float]) -> DataFrame:
    """Values at the wanted ranks of keys that have few distinct values."""
    key = Window.partitionBy("_key")
    upto = F.sum("_n").over(key.orderBy("_v").rowsBetween(Window.unboundedPreceding, 0))
    totals = counted.withColumns({"_last": upto, "_total": F.sum("_n").over(key)})
    held = F.filter(
        _wanted(probabilities), lambda w: (w["rank"] < F.col("_last")) & (w["rank"] >= F.col("_last") - F.col("_n"))
    )
    return totals.select("_key", "_v", "_total", F.explode(held).alias("_w")).select("_key", "_v", "_total", "_w.mark")


def _intervals(counted: DataFrame, probabilities: dict[str, float], slots: int, largest: int) -> DataFrame | None:
    """Per key and mark the interval known to hold its rank; none where no key has many values."""
    spark = counted.sparkSession
    root = scratch_dir(spark, "quantile-marks")
    per_key = counted.groupBy("_key").agg(
        F.min("_v").alias("_low"), F.max("_v").alias("_high"), F.sum("_n").alias("_total"), F.count(F.lit(1)).alias("_values")
    )
    marks = per_key.select(
        "*", F.lit(0).cast("long").alias("_before"), F.explode(_wanted(probabilities)).alias("_w")
    ).select("_key", "_low", "_high", "_total", "_values", "_before", "_w.mark", "_w.rank")
    step = 0
    while True:
        seen = Observation()
        wide = F.col("_values") > largest
        marks.observe(seen, F.count_if(wide).alias("wide")).write.parquet(f"{root}/{step}")
        marks = spark.read.schema(marks.schema).parquet(f"{root}/{step}")
        if not seen.get["wide"]:
            return marks if step else None
        marks = marks.filter(~wide).unionByName(_narrowed(counted, marks.filter(wide), slots))
        step += 1


def _narrowed(counted: DataFrame, marks: DataFrame, slots: int) -> DataFrame:
    """Marks with the one of ``slots`` equal parts of their interval that holds their rank."""
    # halved, so that no difference leaves a long
    half = lambda c: F.shiftright(ordered_form(c), 1)
    # whole-number division of longs: a double would lose their last bits
    cut = marks.drop("_values").withColumns({"_from": half("_low"), "_to": half("_high")})
    cut = cut.withColumn("_step", F.expr(f"(_to - _from) div {slots} + 1"))
    values = counted.withColumn("_at", half("_v"))
    known = ["_key", "mark", "rank", "_total", "_low", "_high", "_before"]
    slot = F.expr("(_at - _from) div _step").alias("_slot")
    parts = (
        values.join(cut, "_key")
        .filter((F.col("_v") >= F.col("_low")) & (F.col("_v") <= F.col("_high")))
        .groupBy(*known, slot)
        .agg(
            F.sum("_n").alias("_n"), F.count(F.lit(1)).alias("_values"),
            F.min("_v").alias("_first"), F.max("_v").alias("_last"),
        )
    )
    running = Window.partitionBy("_key", "mark").orderBy("_slot").rowsBetween(Window.unboundedPreceding, 0)
    upto = parts.withColumn("_upto", F.col("_before") + F.sum("_n").over(running))
    start = F.col("_upto") - F.col("_n")
    held = upto.filter((F.col("rank") < F.col("_upto")) & (F.col("rank") >= start))
    return held.select(
        "_key", F.col("_first").alias("_low"), F.col("_last").alias("_high"), "_total", "_values",
        start.alias("_before"), "mark", "rank",
    )


def _ranked_inside(counted: DataFrame, marks: DataFrame) -> DataFrame:
    """Values at the wanted ranks, from the values inside each mark's interval."""
    inside = Window.partitionBy("_key", "mark").orderBy("_v").rowsBetween(Window.unboundedPreceding, 0)
    return (
        counted.join(marks, "_key")
        .filter((F.col("_v") >= F.col("_low")) & (F.col("_v") <= F.col("_high")))
        .withColumn("_last", F.col("_before") + F.sum("_n").over(inside))
        .filter((F.col("rank") < F.col("_last")) & (F.col("rank") >= F.col("_last") - F.col("_n")))
        .select("_key", "_v", "_total", "mark")
    )


def _position(p: float) -> Column:
    """Zero-based fractional rank of a probability among ``_total`` sorted values."""
    return (F.col("_total") - 1) * F.lit(float(p))
