"""Counting and describing columns."""

from __future__ import annotations

from itertools import combinations_with_replacement

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import MapType, NumericType, StringType
from pyspark.sql.window import Window


def value_counts(df: DataFrame, column: str, name: str = "count") -> DataFrame:
    """(column, count), most frequent first; nulls don't count."""
    return df.where(F.col(column).isNotNull()).groupBy(column).agg(F.count("*").alias(name)).orderBy(F.desc(name), column)


def value_shares(df: DataFrame, column: str) -> DataFrame:
    """(column, count, percent of the values that aren't null, one decimal)."""
    counts = df.where(F.col(column).isNotNull()).groupBy(column).agg(F.count("*").alias("count"))
    total = df.agg(F.count(column)).scalar()
    return counts.select(column, "count", F.round(100 * F.col("count") / total, 1).alias("percent"))


def group_counts(df: DataFrame, key: str) -> DataFrame:
    """Values that aren't null, by group and column; groups of a null key are left out."""
    return df.where(F.col(key).isNotNull()).groupBy(key).agg(*[F.count(c).alias(c) for c in df.columns if c != key])


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema if isinstance(f.dataType, NumericType)]


def _long(df: DataFrame, columns: list[str], facts: dict[str, object]) -> DataFrame:
    """One aggregation over df, turned to a row for each column."""
    row = df.agg(*[make(F.col(c)).alias(f"{name}__{i}") for i, c in enumerate(columns) for name, make in facts.items()])
    return row.select(F.explode(F.array(*[F.struct(F.lit(c).alias("column"), *[F.col(f"{name}__{i}").alias(name) for name in facts]) for i, c in enumerate(columns)])).alias("r")).select("r.*")


#: Ranges of values in which ranks are counted.
RANGES = 64


def quantiles(df: DataFrame, columns: list[str], shares: dict[str, float]) -> DataFrame:
    """(column, n, and one for each of the named shares): exact quantiles with linear interpolation, nulls left out.

    Values are counted where they are read, then ordered in ranges whose
    borders come from a sketch; counts by range tell at which rank each
    begins. No task holds or sorts all values of a column. Broadcast are the
    borders and counts: RANGES numbers for each column.
    """
    values = df.select(F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("double").alias("value")) for c in columns])).alias("v")).select("v.*").where("value IS NOT NULL")
    counts = values.groupBy("column", "value").agg(F.count("*").alias("times"))
    borders = values.groupBy("column").agg(F.percentile_approx("value", [i / RANGES for i in range(1, RANGES)], 1000).alias("borders"))
    dealt = counts.join(F.broadcast(borders), "column").select("column", "value", "times", F.size(F.filter("borders", lambda b: b < F.col("value"))).alias("range"))
    per = dealt.groupBy("column", "range").agg(F.sum("times").alias("n"))
    by_column = Window.partitionBy("column")
    per = per.select("column", "range", (F.sum("n").over(by_column.orderBy("range")) - F.col("n")).alias("from"), F.sum("n").over(by_column).alias("n"))
    upto = F.sum("times").over(Window.partitionBy("column", "range").orderBy("value").rowsBetween(Window.unboundedPreceding, 0))
    ranked = dealt.withColumn("upto", upto).join(F.broadcast(per), ["column", "range"]).select("column", "value", "n", (F.col("from") + F.col("upto") - F.col("times")).alias("first"), (F.col("from") + F.col("upto") - 1).alias("last"))

    def share(q: float) -> Column:
        at = (F.col("n") - 1) * F.lit(q)
        low, high = F.floor(at), F.ceil(at)
        part = F.when(low.between(F.col("first"), F.col("last")), F.col("value") * (1 - (at - low))).otherwise(0.0)
        return F.sum(part + F.when((high > low) & high.between(F.col("first"), F.col("last")), F.col("value") * (at - low)).otherwise(0.0))

    return ranked.groupBy("column").agg(F.max("n").alias("n"), *[share(q).alias(name) for name, q in shares.items()])


def describe(df: DataFrame, columns: list[str] | None = None, exact: bool = True) -> DataFrame:
    """count, mean, std, min, quartiles (linear interpolation) and max of numeric columns, a row for each.

    ``exact=False`` takes quantile sketches, in one scan and without a shuffle of values.
    """
    columns = columns or numeric_columns(df)
    shares = {"q25": 0.25, "q50": 0.5, "q75": 0.75}
    facts = {"count": F.count, "mean": lambda c: F.avg(c.cast("double")), "std": lambda c: F.stddev_samp(c.cast("double")), "min": lambda c: F.min(c.cast("double")), "max": lambda c: F.max(c.cast("double"))}
    order = ("column", "count", "mean", "std", "min", "q25", "q50", "q75", "max")
    if not exact:
        sketch = lambda q: lambda c: F.percentile_approx(c.cast("double"), q, 10_000)
        return _long(df, columns, facts | {name: sketch(q) for name, q in shares.items()}).select(*order)
    return _long(df, columns, facts).join(quantiles(df, columns, shares).drop("n"), "column", "left").select(*order)


def null_counts(df: DataFrame) -> DataFrame:
    return _long(df, df.columns, {"nulls": lambda c: F.count_if(c.isNull()), "non_nulls": F.count})


def column_profile(df: DataFrame) -> DataFrame:
    """Of each column: whether all its values are text, distinct values, and their share."""
    text = {f.name for f in df.schema if isinstance(f.dataType, StringType)}
    out = _long(df, df.columns, {"n": lambda c: F.count("*"), "nulls": lambda c: F.count_if(c.isNull()), "distinct": lambda c: F.countDistinct(c)})
    return out.withColumn("all_text", F.col("column").isin(*text) & (F.col("nulls") == 0) if text else F.lit(False))


def uniqueness_ratio(df: DataFrame, column: str) -> DataFrame:
    """Distinct values over values, of those that aren't null."""
    return df.agg(F.count(column).alias("n"), F.countDistinct(column).alias("distinct")).select("n", "distinct", F.round(F.col("distinct") / F.nullif(F.col("n"), F.lit(0)), 6).alias("ratio"))


def correlations(df: DataFrame, columns: list[str]) -> DataFrame:
    """(a, b, corr) of all pairs of columns, over the rows that have both; null where one is constant."""
    pairs = list(combinations_with_replacement(columns, 2))

    def corr(a: Column, b: Column) -> Column:
        both = a.isNotNull() & b.isNotNull()
        x, y = F.when(both, a.cast("double")), F.when(both, b.cast("double"))
        # Not F.corr, which divides by zero where one of them is constant.
        return F.covar_pop(x, y) / F.nullif(F.stddev_pop(x) * F.stddev_pop(y), F.lit(0.0))

    row = df.agg(*[corr(F.col(a), F.col(b)).alias(f"c{i}") for i, (a, b) in enumerate(pairs)])
    return row.select(F.explode(F.array(*[F.struct(F.lit(a).alias("a"), F.lit(b).alias("b"), F.round(f"c{i}", 6).alias("corr")) for i, (a, b) in enumerate(pairs)])).alias("r")).select("r.*")


def histogram(df: DataFrame, column: str, bins: int = 10) -> DataFrame:
    """(bin from 1, count) of equal-width bins between least and greatest; the last one is closed."""
    low, high = (df.agg(end(F.col(column).cast("double"))).scalar() for end in (F.min, F.max))
    at = F.when(low == high, 1).otherwise(F.least(F.width_bucket(F.col(column).cast("double"), low, high, F.lit(bins)), F.lit(bins)))
    return df.where(F.col(column).isNotNull()).select(at.cast("int").alias("bin")).groupBy("bin").agg(F.count("*").alias("count"))


def iqr_outliers(df: DataFrame, columns: list[str], reach: float = 1.5) -> DataFrame:
    """Quartiles, fences and the number of values beyond them, a row for each column; the fences, as many rows, are broadcast."""
    quartiles = quantiles(df, columns, {"q1": 0.25, "q3": 0.75})
    fences = quartiles.select("column", "q1", "q3", (F.col("q1") - reach * (F.col("q3") - F.col("q1"))).alias("low"), (F.col("q3") + reach * (F.col("q3") - F.col("q1"))).alias("high"))
    values = df.select(F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("double").alias("value")) for c in columns])).alias("v")).select("v.*")
    found = values.join(F.broadcast(fences), "column").groupBy("column", "q1", "q3", "low", "high").agg(F.count_if((F.col("value") < F.col("low")) | (F.col("value") > F.col("high"))).alias("outliers"))
    every = df.sparkSession.createDataFrame([(c,) for c in columns], "column string")
    return every.join(found, "column", "left").select("column", "q1", "q3", "low", "high", "outliers")


def _rank(key: Column, borders: list[Column], low: int = 0, high: int | None = None) -> Column:
    """How many of the borders, in order, are not above the key: by halves, not one after the other."""
    high = len(borders) if high is None else high
    if low == high:
        return F.lit(low)
    middle = (low + high) // 2
    return F.when(borders[middle] <= key, _rank(key, borders, middle + 1, high)).otherwise(_rank(key, borders, low, middle))


def with_row_id(df: DataFrame, *order: str, name: str = "id", parts: int | None = None) -> DataFrame:
    """df with its rows numbered from 0 in the given order (nulls first); the number comes first.

    Numbered in two steps, so that no task holds all rows: they are dealt to
    ranges of the order whose borders come from a bounded sample, counted by
    range, and numbered within. The borders are literals, so a task that runs
    again deals its rows alike. Rows that agree in the order are told apart by
    a hash of all their columns, so that many of them are many ranges; of rows
    alike in all columns any may be first. To the driver come 20 keys a range,
    and counts, as many as ranges, are broadcast.
    """
    parts = parts or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = df.withColumn("__tie", F.xxhash64(*[f.name for f in df.schema if not isinstance(f.dataType, MapType)]))
    order = (*order, "__tie")
    key = F.struct(*order)
    keys = dealt.select(key.alias("key")).orderBy(F.xxhash64("key")).limit(20 * parts).select("key.*").orderBy(*order).collect()
    kinds = [dealt.schema[c].dataType for c in order]
    borders = [F.struct(*[F.lit(v).cast(k).alias(c) for v, k, c in zip(keys[i], kinds, order, strict=True)]) for i in range(20, len(keys), 20)]
    dealt = dealt.withColumn("__part", _rank(key, borders))
    within = dealt.withColumn("__n", F.row_number().over(Window.partitionBy("__part").orderBy(*order)))
    starts = dealt.groupBy("__part").agg(F.count("*").alias("__c")).withColumn("__from", F.sum("__c").over(Window.orderBy("__part")) - F.col("__c")).drop("__c")
    return within.join(F.broadcast(starts), "__part").select((F.col("__from") + F.col("__n") - 1).alias(name), *df.columns)
