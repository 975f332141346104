"""Session and schema helpers of the operators."""

from __future__ import annotations

import tempfile
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Columns of the documents table.
DOCUMENT_COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def shared_checkpoints(spark: SparkSession) -> str:
    """Set the checkpoint folder from spark.checkpoint.dir, which all executors of a cluster share.
    Where that is unset a session on one machine gets a temporary folder; any other is refused,
    because its executors would write to disks that nobody else can read."""
    sc = spark.sparkContext
    if sc._jsc.sc().getCheckpointDir().isEmpty():
        folder = sc.getConf().get("spark.checkpoint.dir")
        if not folder and not (sc.master.startswith("local") and not sc.master.startswith("local-cluster")):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        sc.setCheckpointDir(folder or tempfile.mkdtemp(prefix="tidemark-"))
    return sc._jsc.sc().getCheckpointDir().get()


def checkpointed(df: DataFrame) -> DataFrame:
    """Cut the lineage through the shared folder: survives the loss of executors."""
    shared_checkpoints(df.sparkSession)
    return df.checkpoint(eager=True)


def fresh(df: DataFrame, *names: str) -> list[str]:
    """Column names that no column of df has, case ignored."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in names:
        while name.lower() in taken:
            name = f"_{name}"
        taken.add(name.lower())
        out.append(name)
    return out


def text_of(text_col: str) -> Column:
    """The text with null as empty: what every document operator reads."""
    return F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit(""))


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


#: Rows of (long) keys up to which a side is broadcast; beyond, the join shuffles.
BROADCAST_KEYS = 1_000_000


def sized(keys: DataFrame, limit: int = BROADCAST_KEYS) -> DataFrame:
    """Mark a side for broadcast only if a count of it shows that it is small."""
    return F.broadcast(keys) if keys.limit(limit + 1).count() <= limit else keys


@dataclass
class Keyed:
    """docs with a long key a row: `key` names its column, null where the row has no id."""

    docs: DataFrame
    key: str
    names: DataFrame | None  # (key, id), or None where the key is the id
    id_type: str

    def named(self, df: DataFrame, *columns: str) -> DataFrame:
        """df with the keys in these columns replaced by the ids that they stand for."""
        if self.names is None:
            return df
        order = df.columns
        for c in columns:
            df = df.join(self.names.toDF(c, "tm_named"), c).drop(c).withColumnRenamed("tm_named", c)
        return df.select(*order)


def row_keys(docs: DataFrame, id_col: str = "doc_id") -> Keyed:
    """A long key for every row that has an id, in the order of the ids.

    Unrepeated ids of a whole-number type are keys themselves; that costs a count over the id column.
    Otherwise (ids of any other type, or rows that share an id) rows are numbered in the order of (id, hash of
    the row): by a range sort, so that an id with a third of the rows is many tasks' work, and with docs written
    once to the shared folder.  So no row is lost, whatever its id, and rows that share an id are rows like others.
    """
    kind = dict(docs.dtypes)[id_col]
    if kind in ("tinyint", "smallint", "int", "bigint"):
        ids = docs.select(F.col(f"`{id_col}`").alias("k")).where("k IS NOT NULL")
        if ids.groupBy("k").count().where("count > 1").isEmpty():
            if kind == "bigint":
                return Keyed(docs, id_col, None, kind)
            (key,) = fresh(docs, "tm_key")
            return Keyed(docs.withColumn(key, F.col(f"`{id_col}`").cast("long")), key, None, kind)
    row, key = fresh(docs, "tm_row", "tm_key")
    saved = checkpointed(docs.withColumn(row, F.monotonically_increasing_id()))
    content = F.xxhash64(F.to_json(F.struct(*[F.col(f"`{c}`") for c in docs.columns])))
    order = saved.where(F.col(f"`{id_col}`").isNotNull()).select(F.col(f"`{id_col}`").alias("id"), content.alias("h"), F.col(row).alias("row")).orderBy("id", "h", "row")
    order = checkpointed(order.select(F.monotonically_increasing_id().alias("key"), "id", "row"))
    joined = checkpointed(saved.join(order.select(F.col("row").alias(row), F.col("key").alias(key)), row, "left").drop(row))
    return Keyed(joined, key, order.select("key", "id"), kind)


def components(edges: DataFrame) -> DataFrame:
    """Connected components of edges (u, v): (id, label), label the least id, for ids that
    differ from it.  Alternating large-star and small-star rounds: each is two grouped
    shuffles of the edges, and their number grows with the log of the longest path."""
    from pyspark.sql import Window

    state = checkpointed(edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).where("u <> v").distinct())
    seen = None
    while True:
        sign = state.select(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if tuple(sign) == seen or not sign[0]:
            return state.select(F.col("u").alias("id"), F.col("v").alias("label"))
        seen = tuple(sign)
        both = state.unionByName(state.select(F.col("v").alias("u"), F.col("u").alias("v")))
        w = Window.partitionBy("u")
        large = both.withColumn("m", F.least(F.min("v").over(w), F.col("u"))).where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        small = large.withColumn("m", F.min("v").over(w)).select(F.explode(F.array(F.struct(F.col("u"), F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("e")).select("e.*")
        state = checkpointed(small.where("u <> v").distinct())
