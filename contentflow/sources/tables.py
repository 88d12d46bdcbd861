"""Tables that are appended to again and again: co-located keys, batches that replace
themselves, rows that are put aside, partitions that expire (SNK-02, SNK-03, SNK-07,
SRC-06, SRC-07).

Tables are catalog tables over a folder of their own; ``attach`` makes a session that
has not seen one before know it again (its layout is given, its partitions are found).
"""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .io import one_per_key

KEY = "_key"
BATCH = "_batch"


def key_text(keys: list[str]) -> Column:
    """The keys as one text that is never null and different for different keys (so that
    null keys meet and the join needs a plain equality only)."""
    def part(k: str) -> Column:
        c = F.col(k).cast("string")
        return F.coalesce(F.concat(F.length(c).cast("string"), F.lit(":"), c), F.lit("-"))
    return F.concat(*[part(k) for k in keys])


def _columns(schema: T.StructType) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)


def attach(spark: SparkSession, name: str, path: str, schema: T.StructType, *, partition: str, bucket: str | None = None,
           buckets: int = 0) -> None:
    """``CREATE TABLE IF NOT EXISTS`` over ``path`` with its layout, partitions found."""
    layout = f" CLUSTERED BY (`{bucket}`) SORTED BY (`{bucket}`) INTO {buckets} BUCKETS" if bucket else ""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({_columns(schema)}) USING parquet PARTITIONED BY (`{partition}`){layout} LOCATION '{path}'")
    try:
        spark.sql(f"ALTER TABLE {name} RECOVER PARTITIONS")
    except Exception as e:  # noqa: BLE001  (Spark raises the store's own error)
        if "FileNotFoundException" not in str(e):  # nothing was written yet
            raise


# ---------------------------------------------------------------- SNK-02
def bucketed_schema(schema: T.StructType) -> T.StructType:
    return T.StructType([*schema.fields, T.StructField(KEY, T.StringType()), T.StructField(BATCH, T.StringType())])


def new_rows(df: DataFrame, table: str, keys: list[str], batch: str, buckets: int) -> DataFrame:
    """One row per key of ``df`` whose key no other batch of ``table`` holds.

    The table is bucketed and sorted by its key text: the anti-join shuffles the new rows
    alone, into as many partitions, and reads the table where it lies."""
    fresh = one_per_key(df, keys).withColumn(KEY, key_text(keys)).repartition(buckets, KEY)
    stored = df.sparkSession.table(table).where(F.col(BATCH) != batch).select(F.col(KEY).alias("_stored"))
    return fresh.hint("merge").join(stored, F.col(KEY) == F.col("_stored"), "left_anti")


def append_batch(df: DataFrame, name: str, path: str, keys: list[str], batch: str, *, buckets: int = 32) -> None:
    """SNK-02: rows of ``df`` with new keys become the partition ``batch`` of the table.

    A batch that runs again (killed or repeated) replaces its own partition and is
    compared with the others only, so nothing is added twice and nothing is lost; two
    batches at a time can both add a key that neither sees."""
    spark = df.sparkSession
    schema = bucketed_schema(df.schema)
    attach(spark, name, path, schema, partition=BATCH, bucket=KEY, buckets=buckets)
    view = "_new_" + name.replace(".", "_")
    new_rows(df, name, keys, batch, buckets).select(*df.columns, KEY, F.lit(batch).alias(BATCH)).createOrReplaceTempView(view)
    mode = "spark.sql.sources.partitionOverwriteMode"
    before = spark.conf.get(mode)
    spark.conf.set(mode, "dynamic")  # the partitions of the rows are replaced, no others
    try:
        spark.sql(f"INSERT OVERWRITE TABLE {name} PARTITION (`{BATCH}`) SELECT * FROM {view}")
    finally:
        spark.conf.set(mode, before)
        spark.catalog.dropTempView(view)


# ---------------------------------------------------------------- SNK-03
def checked(df: DataFrame, rules: dict[str, Column]) -> tuple[DataFrame, DataFrame]:
    """(rows that keep every rule, the others with the ``reason``: the first rule broken).

    A rule that is null counts as broken."""
    reason = None
    for name, rule in rules.items():
        broken = ~F.coalesce(rule, F.lit(False))
        reason = F.when(broken, F.lit(name)) if reason is None else reason.when(broken, F.lit(name))
    marked = df.withColumn("reason", reason)
    return marked.where("reason IS NULL").drop("reason"), marked.where("reason IS NOT NULL")


def append_checked(stream: DataFrame, path: str, rules: dict[str, Column], parse: dict[str, Column], checkpoint: str):
    """SNK-03 with row-level errors: each micro-batch writes its good rows and its bad
    rows under its ``_epoch``, then the epoch's mark.  A replayed epoch replaces all three;
    readers see marked epochs only, so good and bad rows of a batch appear together.

    ``parse``: columns of the good rows, from the raw ones.  The target is never read."""
    def sink(batch: DataFrame, epoch: int) -> None:
        good, bad = checked(batch, rules)
        for name, part in (("bad", bad), ("rows", good.select(*[c.alias(k) for k, c in parse.items()])),
                           ("marks", batch.sparkSession.range(1).select(F.lit(True).alias("done")))):
            (part.withColumn("_epoch", F.lit(epoch)).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
             .partitionBy("_epoch").parquet(f"{path}/{name}"))

    return (stream.writeStream.option("checkpointLocation", checkpoint).foreachBatch(sink).trigger(availableNow=True).start())


def read_checked(spark: SparkSession, path: str, schemas: dict[str, T.StructType], keys: list[str]) -> tuple[DataFrame, DataFrame]:
    """Good rows (per key those of the earliest epoch) and bad rows of the marked epochs."""
    epoch = T.StructField("_epoch", T.IntegerType())
    marks = spark.read.schema(T.StructType([T.StructField("done", T.BooleanType()), epoch])).parquet(f"{path}/marks").select("_epoch")

    def part(name: str) -> DataFrame:
        return spark.read.schema(T.StructType([*schemas[name].fields, epoch])).parquet(f"{path}/{name}").join(marks, "_epoch", "left_semi")
    rest = [f.name for f in schemas["rows"].fields if f.name not in keys]
    first = part("rows").groupBy(*keys).agg(F.min(F.struct("_epoch", *rest)).alias("_r"))
    rows = first.select(*keys, *[F.col("_r")[c].alias(c) for c in rest]).select(*schemas["rows"].fieldNames())
    return rows, part("bad").drop("_epoch")


# ---------------------------------------------------------------- SNK-07
def partition_days(spark: SparkSession, name: str, column: str = "ingest_date") -> list[str]:
    """Days of the table's partitions, from its metadata alone."""
    rows = spark.sql(f"SHOW PARTITIONS {name}").collect()
    pairs = [dict(p.partition("=")[::2] for p in r["partition"].split("/")) for r in rows]
    return sorted(p[column] for p in pairs)


def retain_table(spark: SparkSession, name: str, scratch: str, ts: str, days: int, *, as_of: str, column: str = "ingest_date") -> list[str]:
    """SNK-07 on a managed table partitioned by day: whole days older than ``days`` at
    ``as_of`` are dropped without reading them, only the cut-off day is rewritten (staged
    under ``scratch`` first), all others stay as they are.  Returns the days dropped."""
    moment = F.lit(as_of).cast("timestamp") - F.make_interval(F.lit(0), F.lit(0), F.lit(0), F.lit(days))
    cut = (date.fromisoformat(str(as_of)[:10]) - timedelta(days=days)).isoformat()
    have = partition_days(spark, name, column)
    gone = [d for d in have if d < cut]
    if gone:
        spec = ", ".join(f"PARTITION (`{column}` = '{d}')" for d in gone)
        spark.sql(f"ALTER TABLE {name} DROP IF EXISTS {spec}")
    if cut in have:
        day = spark.table(name).where(F.col(column) == F.lit(cut).cast("date"))
        day.where(F.col(ts) >= moment).write.mode("overwrite").parquet(scratch)
        rest = [f"`{c}`" for c in spark.table(name).columns if c != column]
        view = f"_staged_{name.replace('.', '_')}"
        spark.read.schema(spark.table(name).schema).parquet(scratch).createOrReplaceTempView(view)
        try:
            spark.sql(f"INSERT OVERWRITE TABLE {name} PARTITION (`{column}` = '{cut}') SELECT {', '.join(rest)} FROM {view}")
        finally:
            spark.catalog.dropTempView(view)
    return gone


# ---------------------------------------------------------------- SRC-06 / SRC-07
def write_partitioned(df: DataFrame, path: str, column: str) -> None:
    """A file per partition value and task that holds it: rows of a value are dealt by
    their hash to a few tasks, so a hot value is not one task."""
    spread = F.pmod(F.xxhash64(*[F.col(f.name) for f in df.schema.fields if not isinstance(f.dataType, (T.MapType, T.VariantType))]), F.lit(4))
    df.repartition(F.col(column), spread).write.mode("overwrite").partitionBy(column).parquet(path)


def write_managed(df: DataFrame, name: str, column: str) -> None:
    """The same as a managed table: what is dropped from it is deleted."""
    df.repartition(F.col(column)).write.mode("overwrite").partitionBy(column).format("parquet").saveAsTable(name)


def in_days_of(df: DataFrame, days: DataFrame, column: str) -> DataFrame:
    """Rows whose partition value occurs in ``days``: on a partitioned table the values are
    found first and prune the scan (dynamic partition pruning)."""
    return df.join(days.select(F.col(column).alias("_day")).distinct(), F.col(column) == F.col("_day"), "left_semi")
