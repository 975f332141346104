"""Counts, rates and gates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.operators.rank import top_per_key


def status_counts(df: DataFrame, *keys: str) -> DataFrame:
    return df.groupBy(*keys).agg(F.count("*").alias("n"))


def conditional_counts(df: DataFrame, keys: list[str], **conditions: Column) -> DataFrame:
    """Many counts in one pass over the rows."""
    return df.groupBy(*keys).agg(F.count("*").alias("n"), *(F.count_if(c).alias(name) for name, c in conditions.items()))


def all_reach(df: DataFrame, key: str, done: Column, target: int) -> DataFrame:
    """One row: whether every key has target rows that are done; no keys are not ready."""
    per = df.groupBy(key).agg(F.count_if(done).alias("n"))
    return per.agg(F.count("*").alias("keys"), F.coalesce(F.bool_and(F.col("n") >= target), F.lit(False)).alias("ready"))


def years_ready(df: DataFrame, year: str, first: int, last: int, least: int) -> DataFrame:
    """Whether each year of the range, those without rows too, has at least so many rows."""
    spark = df.sparkSession
    years = spark.range(first, last + 1).select(F.col("id").cast("int").alias("year"))
    n = df.groupBy(F.col(year).cast("int").alias("year")).agg(F.count("*").alias("n"))
    return years.join(n, "year", "left").select("year", F.coalesce("n", F.lit(0)).alias("n"), (F.coalesce("n", F.lit(0)) >= least).alias("ready"))


def under_target(df: DataFrame, keys: list[str], value: Column, target: float) -> DataFrame:
    return df.groupBy(*keys).agg(F.sum(value).alias("total")).where(F.col("total") < target)


def catalog_years(catalogs: list[DataFrame], least: int = 0) -> DataFrame:
    """(year, articles): distinct URLs of each year over catalogs of (url, published as ISO text); only years with
    `least` of them."""
    both = catalogs[0].select("url", "published")
    for c in catalogs[1:]:
        both = both.unionByName(c.select("url", "published"))
    return both.where("url IS NOT NULL").groupBy(F.substring("published", 1, 4).try_cast("int").alias("year")).agg(F.countDistinct("url").alias("articles")).where(F.col("articles") >= least)


def status_summary(df: DataFrame, status: str = "status", sums: tuple[str, ...] = (), averages: tuple[str, ...] = (), digits: int = 2) -> DataFrame:
    """One row: rows by status (a map in the order of the statuses), their number, sums (0 where there are none) and
    rounded averages.  Rows are counted by status before anything is shuffled; there are as many rows in the map as
    statuses."""
    per = df.groupBy(status).agg(F.count("*").alias("n"), *(F.sum(c).alias(f"s_{c}") for c in (*sums, *averages)), *(F.count(c).alias(f"c_{c}") for c in averages))
    out = [F.map_from_entries(F.array_sort(F.collect_list(F.struct(F.coalesce(F.col(status).cast("string"), F.lit("")), "n")))).alias("by_status"), F.coalesce(F.sum("n"), F.lit(0)).alias("rows")]
    out += [F.coalesce(F.sum(f"s_{c}"), F.lit(0)).alias(c) for c in sums]
    out += [F.round(F.sum(f"s_{c}") / F.nullif(F.sum(f"c_{c}"), F.lit(0)), digits).alias(f"average_{c}") for c in averages]
    return per.agg(*out)


def shown(counts: Column) -> Column:
    """A map of counts as text, in its order."""
    return F.array_join(F.transform(F.map_entries(counts), lambda e: F.concat_ws("=", e["key"], e["value"].cast("string"))), ";")


def catalog_summary(tables: dict[str, DataFrame], articles: DataFrame, target: int, most_attempts: int = 3) -> DataFrame:
    """One row for a source's discovery: a map of statuses for each of its tables (status, attempts), articles by year
    and whether any work is left that a year under target still needs."""
    spark = articles.sparkSession
    out = None
    for name, df in tables.items():
        one = status_summary(df).select(F.col("by_status").alias(name))
        out = one if out is None else out.crossJoin(one)  # one row each
    years = catalog_years([articles])
    per = years.agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("year", "articles")))).alias("years"), F.coalesce(F.sum("articles"), F.lit(0)).alias("articles"), F.coalesce(F.bool_or(F.col("articles") < target), F.lit(True)).alias("short"))
    left = None
    for df in tables.values():
        open_ = df.where(F.col("status").isin("pending", "error") & (F.col("attempts") < most_attempts)).select(F.lit(1).alias("x"))
        left = open_ if left is None else left.unionByName(open_)
    more = left.agg((F.count("*") > 0).alias("work"))
    return (out if out is not None else spark.range(1).select()).crossJoin(per).crossJoin(more).withColumn("should_continue", F.col("short") & F.col("work")).drop("short", "work")


def validation(results: DataFrame, target: int, least_complete: float = 0.95, most_failures: int = 20) -> DataFrame:
    """Per sample_year of (sample_year, canonical_url, status, qa_pass, issues): counts, rates, issues by name,
    the first failures by URL, and whether the year is ready."""
    r = results
    per = r.groupBy("sample_year").agg(
        F.count("*").alias("evaluated"),
        F.count_if(F.col("status") == "complete").alias("complete"),
        F.count_if("qa_pass").alias("passed"),
        F.count_if(F.col("status") == "failed").alias("failed"),
    )
    failed = top_per_key(r.where(~F.col("qa_pass")).select("sample_year", "canonical_url").distinct(), ["sample_year"], ["canonical_url"], most_failures)
    failed = failed.groupBy("sample_year").agg(F.array_sort(F.collect_list("canonical_url")).alias("failures"))
    issues = r.select("sample_year", F.explode("issues").alias("issue")).groupBy("sample_year", "issue").agg(F.count("*").alias("n"))
    issues = issues.groupBy("sample_year").agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("issue", "n")))).alias("issues"))
    rate = lambda c: F.col(c) / F.col("evaluated")
    out = per.join(failed, "sample_year", "left").join(issues, "sample_year", "left")
    ready = (F.col("evaluated") >= target) & (rate("complete") >= least_complete) & (F.col("passed") == F.col("evaluated")) & (F.col("failed") == 0)
    return out.withColumns({"complete_rate": F.round(rate("complete"), 4), "pass_rate": F.round(rate("passed"), 4), "ready": ready})
