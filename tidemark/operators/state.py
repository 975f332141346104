"""State tables as Parquet snapshots: upserts with a rule for each column.

A snapshot is a folder v=N.  An upsert is one full outer join by key of the last snapshot and a batch,
written as v=N+1; readers see a version only when its commit is complete.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

RULES = ("new", "old", "least", "greatest", "new_if_set", "insert_only")


def upsert(old: DataFrame, new: DataFrame, keys: list[str], rules: dict[str, str], when: Column | None = None) -> DataFrame:
    """Columns by rule: new (overwrite), new_if_set (new unless null), old (old unless null), least, greatest,
    insert_only (kept as first inserted).  when: over old.* and new.*, rows that it refuses stay as they are.
    A column without a rule is new.  Keys must be unique on each side."""
    if bad := set(rules.values()) - set(RULES):
        raise ValueError(f"unknown rules: {sorted(bad)}")
    o = old.select(*keys, F.struct(*old.columns).alias("old"))
    n = new.select(*keys, F.struct(*new.columns).alias("new"))
    pick = {
        "new": lambda a, b: b,
        "new_if_set": lambda a, b: F.coalesce(b, a),
        "old": lambda a, b: F.coalesce(a, b),
        "least": lambda a, b: F.least(a, b),
        "greatest": lambda a, b: F.greatest(a, b),
        "insert_only": lambda a, b: a,
    }
    both = F.col("old").isNotNull() & F.col("new").isNotNull()
    change = both if when is None else both & F.coalesce(when, F.lit(False))
    out = []
    for c in old.columns:
        a, b = F.col("old")[c], F.col("new")[c]
        out.append(F.col(c) if c in keys else F.when(change, pick[rules.get(c, "new")](a, b)).when(F.col("old").isNotNull(), a).otherwise(b).alias(c))
    return o.join(n, keys, "full_outer").select(*out)


def insert_absent(old: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    return old.unionByName(new.join(old, keys, "left_anti").dropDuplicates(keys))


def without_stale(results: DataFrame, captures: DataFrame, key: str, digest: str) -> DataFrame:
    """Results whose stored digest is still that of the capture, or that have no capture."""
    now = captures.select(F.col(key), F.col(digest).alias("tm_now"))
    return results.join(now, key, "left").where(F.col("tm_now").isNull() | F.col(digest).eqNullSafe(F.col("tm_now"))).drop("tm_now")


def versions(spark: SparkSession, folder: str) -> list[int]:
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(path):
        return []
    names = [s.getPath().getName() for s in fs.listStatus(path) if fs.exists(spark._jvm.org.apache.hadoop.fs.Path(s.getPath(), "_SUCCESS"))]
    return sorted(int(n[2:]) for n in names if n.startswith("v=") and n[2:].isdigit())


def read_state(spark: SparkSession, folder: str, schema: str) -> DataFrame:
    v = versions(spark, folder)
    return spark.read.schema(schema).parquet(f"{folder}/v={v[-1]}") if v else spark.createDataFrame([], schema)


def write_state(df: DataFrame, folder: str) -> int:
    v = versions(df.sparkSession, folder)
    n = v[-1] + 1 if v else 1
    df.write.mode("overwrite").parquet(f"{folder}/v={n}")
    return n


def content_store(df: DataFrame, content: str = "content") -> DataFrame:
    """(sha256, content): each distinct content once, named by its hash."""
    return df.select(F.sha2(content, 256).alias("sha256"), F.col(content).alias("content")).where("content IS NOT NULL").dropDuplicates(["sha256"])


def better_record(old: DataFrame, new: DataFrame, key: str, score: str) -> DataFrame:
    """Per key the record of the higher score, the existing one of equals."""
    both = old.withColumn("tm_old", F.lit(1)).unionByName(new.withColumn("tm_old", F.lit(0)))
    w = Window.partitionBy(key).orderBy(F.desc(score), F.desc("tm_old"))
    return both.withColumn("tm_k", F.row_number().over(w)).where("tm_k = 1").drop("tm_k", "tm_old")


def reload_manifest(old: DataFrame, new: DataFrame, dynamic: tuple[str, ...] = ("live-origin",)) -> DataFrame:
    """Captures (url, published, section, candidates, status, attempts) after a manifest (url, published, section,
    candidates) is loaded again.

    Dates and sections: the new ones unless null.  Only pending and failed rows take the new candidates, and
    keep those that a dynamic provider added; a failed row is pending again only if its candidates changed."""
    o, n = old.alias("o"), new.alias("n")
    both = o.join(n, F.col("o.url") == F.col("n.url"), "full_outer")
    fresh_ = F.col("o.url").isNull()
    free = F.col("n.url").isNotNull() & F.col("o.status").isin("pending", "error")
    kept = F.filter("o.candidates", lambda c: c["provider"].isin(*dynamic))
    put = F.concat(F.col("n.candidates"), F.filter(kept, lambda c: ~F.exists("n.candidates", lambda m: m["snapshotUrl"] == c["snapshotUrl"])))
    changed = free & (F.transform(put, lambda c: c["snapshotUrl"]) != F.transform("o.candidates", lambda c: c["snapshotUrl"]))
    again = changed & (F.col("o.status") == "error")
    return both.select(
        F.coalesce("o.url", "n.url").alias("url"),
        F.coalesce("n.published", "o.published").alias("published"),
        F.coalesce("n.section", "o.section").alias("section"),
        F.when(fresh_, F.col("n.candidates")).when(free, put).otherwise(F.col("o.candidates")).alias("candidates"),
        F.when(fresh_ | again, "pending").otherwise(F.col("o.status")).alias("status"),
        F.when(fresh_ | again, 0).otherwise(F.col("o.attempts")).alias("attempts"),
    )


def reconcile(queries: DataFrame, articles: DataFrame, target: int) -> DataFrame:
    """Queries (year, status) closed where their year has target distinct articles (year, url), reopened where not."""
    n = articles.groupBy("year").agg(F.countDistinct("url").alias("n"))
    has = F.coalesce("n", F.lit(0)) >= target
    status = F.when(has & F.col("status").isin("pending", "error"), "closed").when(~has & (F.col("status") == "closed"), "pending").otherwise(F.col("status"))
    return queries.join(n, "year", "left").withColumn("status", status).drop("n")


def split_undated(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(dated, undated): captures without a date are withheld until one is found."""
    return rows.where("published IS NOT NULL"), rows.where("published IS NULL")


def promote(undated: DataFrame, found: DataFrame, keep: int = 3) -> DataFrame:
    """Withheld captures (url, captured, digest, snapshot) whose date was found (url, published), ranked and trimmed."""
    from tidemark.functions import dates
    from tidemark.operators.rank import top_per_key

    rows = undated.drop("published").join(found, "url").withColumn("rank", dates.capture_distance(F.col("captured"), F.col("published")))
    return top_per_key(rows, ["url"], ["rank", "captured", "digest", "snapshot"], keep).drop("rank")


def selected(rows: DataFrame, keys: DataFrame, key: str) -> DataFrame:
    """Rows of the chosen keys."""
    return rows.join(keys.select(key), key, "left_semi")


def resources(captures: DataFrame, keys: DataFrame, column: str = "dependent_resources_json") -> DataFrame:
    """Distinct resource paths of the chosen captures; text that is no JSON array of objects has none."""
    paths = F.transform(F.from_json(column, "array<struct<path string>>"), lambda r: r["path"])
    return selected(captures, keys, "canonical_url").select(F.explode(paths).alias("path")).where("path IS NOT NULL").distinct()
