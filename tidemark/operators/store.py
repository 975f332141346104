"""Stores of captures: content-addressed objects, immutable records, indexes of what is complete, checkpoints."""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators import state

KINDS = {"html": ("html", True), "body": ("html", True), "resource": ("bin", False), "image": ("img", False)}


def object_path(sha256: Column, kind: str, extension: str | None = None) -> Column:
    """objects/<kind>/aa/<sha256>.<extension>, .gz where the kind is compressed: the first two digits spread the folder."""
    name, packed = KINDS[kind]
    return F.concat(F.lit(f"objects/{kind}/"), F.substring(sha256, 1, 2), F.lit("/"), sha256, F.lit(f".{extension or name}{'.gz' if packed else ''}"))


def objects(df: DataFrame, kind: str, content: str = "content", extension: str | None = None) -> DataFrame:
    """(sha256, path, bytes, content): each distinct content once.  Two contents of one name fail the job."""
    named = df.select(F.sha2(content, 256).alias("sha256"), F.col(content).alias("content")).where("content IS NOT NULL")
    once = named.groupBy("sha256").agg(F.min("content").alias("content"), F.max("content").alias("other"))
    same = F.when(F.col("content") != F.col("other"), F.raise_error(F.concat(F.lit("two contents of one name: "), "sha256"))).otherwise(F.col("content"))
    return once.select("sha256", object_path(F.col("sha256"), kind, extension).alias("path"), F.octet_length("content").cast("bigint").alias("bytes"), same.alias("content"))


def put(store: DataFrame, new: DataFrame) -> DataFrame:
    """A store of objects with those of `new` that it lacks."""
    return store.unionByName(new.join(store.select("sha256"), "sha256", "left_anti").select(*store.columns))


def write_objects(new: DataFrame, folder: str) -> None:
    """Objects as Parquet by the first two digits of their names: millions of small files would be the slow way."""
    new.withColumn("shard", F.substring("sha256", 1, 2)).repartition("shard").write.mode("append").partitionBy("shard").parquet(folder)


def put_records(records: DataFrame, new: DataFrame, key: str) -> DataFrame:
    """Immutable records: new ones are added, equal ones again are nothing, and one that differs from what its key has
    fails the job."""
    text = lambda: F.to_json(F.struct(*[F.col(c) for c in records.columns]))
    old = records.select(key, F.sha2(text(), 256).alias("tm_old"))
    rows = new.select(*records.columns).distinct().withColumn("tm_new", F.sha2(text(), 256)).join(old, key, "left")
    differs = F.col("tm_old").isNotNull() & (F.col("tm_old") != F.col("tm_new"))
    checked = rows.withColumn(key, F.when(differs, F.raise_error(F.concat(F.lit("record differs from what is stored: "), F.col(key).cast("string")))).otherwise(F.col(key)))
    return records.unionByName(checked.where("tm_old IS NULL OR tm_old <> tm_new").select(*records.columns))


def completed_index(captures: DataFrame) -> DataFrame:
    """(canonical_url, publisher, raw_path, raw_sha256, captured_at) of complete captures.  Paths that aren't relative to
    the archive, or climb out of it, and hashes that aren't SHA-256 are left out."""
    safe = F.col("raw_path").rlike(r"^[^/\\:][^\\:]*$") & ~F.col("raw_path").rlike(r"(?:^|/)\.\.?(?:/|$)")
    return captures.where((F.col("status") == "complete") & safe & F.col("raw_sha256").rlike("^[0-9a-f]{64}$")).select("canonical_url", "publisher", "raw_path", "raw_sha256", "captured_at")


def checkpoint(df: DataFrame, folder: str, backup: str | None = None) -> dict[str, object]:
    """A state as a new version of a folder, readers see it once it is complete; with backup a compressed copy of it too,
    put in place of the last one only when it is whole.  Returns the version and the rows."""
    n = state.write_state(df, folder)
    spark = df.sparkSession
    saved = spark.read.parquet(f"{folder}/v={n}")
    if backup:
        fresh = f"{backup}.new"
        saved.write.mode("overwrite").option("compression", "gzip").json(fresh)
        path = spark._jvm.org.apache.hadoop.fs.Path
        fs = path(backup).getFileSystem(spark._jsc.hadoopConfiguration())
        fs.delete(path(backup), True)
        if not fs.rename(path(fresh), path(backup)):
            raise OSError(f"backup stays at {fresh}")
    return {"version": n, "rows": saved.count()}


def json_schema(df: DataFrame, title: str) -> str:
    """The table's rows as a JSON Schema document."""

    def of(t) -> dict:
        kind = t.typeName()
        if kind == "struct":
            return {"type": "object", "properties": {f.name: of(f.dataType) for f in t.fields}, "required": [f.name for f in t.fields if not f.nullable], "additionalProperties": False}
        if kind == "array":
            return {"type": "array", "items": of(t.elementType)}
        if kind == "map":
            return {"type": "object", "additionalProperties": of(t.valueType)}
        plain = {"string": "string", "boolean": "boolean", "byte": "integer", "short": "integer", "integer": "integer", "long": "integer", "float": "number", "double": "number"}
        if kind in ("timestamp", "timestamp_ntz", "date"):
            return {"type": "string", "format": "date" if kind == "date" else "date-time"}
        return {"type": plain.get(kind, "number" if kind.startswith("decimal") else "string")}

    return json.dumps({"$schema": "https://json-schema.org/draft/2020-12/schema", "title": title} | of(df.schema), sort_keys=True)


def write_schemas(spark: SparkSession, tables: dict[str, DataFrame], folder: str) -> None:
    """One JSON Schema file a table."""
    for name, df in tables.items():
        spark.createDataFrame([(json_schema(df, name),)], "value string").coalesce(1).write.mode("overwrite").text(f"{folder}/{name}.schema.json")
