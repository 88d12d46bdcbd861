"""Readers and writers (SRC-01..09, SNK-01..05).

Paths are parameters; nothing here assumes a machine-local folder.  Scratch
output of the registered queries goes under the session's shared
``spark.checkpoint.dir``.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.utils import AnalysisException

from ..schemas import CRAWL_LANGUAGE, CRAWL_SOURCE, CRAWL_TITLE, MANIFEST, MANIFEST_CHAPTER
from ..session import ensure_checkpoint_dir


# --------------------------------------------------------------------------
# Sources
# --------------------------------------------------------------------------

def read_pages(spark: SparkSession, path: str) -> DataFrame:
    """SRC-01: landed HTML pages (page_id, url, html)."""
    return spark.read.parquet(path).select("page_id", "url", "html")


def read_manifest(spark: SparkSession, path: str, *, multi_line: bool = False) -> DataFrame:
    """SRC-02: crawl manifests -> one row per chapter.  ``multi_line=True`` for
    pretty-printed single-document files; otherwise one manifest per line.
    A manifest without ``chapters`` contributes no row."""
    m = spark.read.schema(MANIFEST).option("multiLine", str(multi_line).lower()).json(path)
    empty = F.array().cast(T.ArrayType(MANIFEST_CHAPTER))
    return m.select("manga", "source", "language", "total_chapters_available",
                    F.col("scraped_at").alias("manifest_scraped_at"),
                    F.explode(F.coalesce(F.col("chapters"), empty)).alias("c")) \
        .select("manga", "source", "language", "total_chapters_available", "manifest_scraped_at",
                "c.*")


def scan_chapters(df: DataFrame) -> DataFrame:
    """SRC-03: the 6 chapter columns, number as BIGINT, ordered by number."""
    return (df.select(F.col("chapter_number").cast("long").alias("chapter_number"), "url",
                      "image_count", "source", "language", "scraped_at")
            .orderBy("chapter_number"))


def scan_speakers(df: DataFrame) -> DataFrame:
    """SRC-04: 5 speaker columns (page omitted), ordered by chapter."""
    return df.select("chapter_number", "speaker", "phrase", "luffy_says_it", "about_luffy") \
        .orderBy("chapter_number")


def shard_files(spark: SparkSession, path_glob: str, between: tuple[str, str] | None = None) -> list[str]:
    """Paths that match the wildcard, those whose parent folder's name lies in the closed
    string range.  Only names are listed (no content column is read)."""
    try:
        names = spark.read.format("binaryFile").load(path_glob).select("path")
    except AnalysisException as e:
        if "PATH_NOT_FOUND" in str(e):
            return []
        raise
    parent = F.regexp_extract("path", r"/([^/]+)/[^/]+$", 1)
    wanted = names if between is None else names.where(parent.between(*between))
    return sorted(r["path"] for r in wanted.collect())


# Widening order of the number types; a type reads as any later one without loss of range.
NUMBERS = ["tinyint", "smallint", "int", "bigint", "float", "double"]


def widened(a: T.DataType, b: T.DataType) -> T.DataType:
    """The type that holds the values of both; STRING where they have nothing in common."""
    if a == b or isinstance(b, T.NullType):
        return a
    if isinstance(a, T.NullType):
        return b
    names = a.simpleString(), b.simpleString()
    if all(n in NUMBERS for n in names):
        wide = max(names, key=NUMBERS.index)
        # FLOAT does not hold every INT or BIGINT.
        return T.DoubleType() if wide == "float" and min(names, key=NUMBERS.index) in ("int", "bigint") else T._parse_datatype_string(wide)
    if isinstance(a, T.DecimalType) and isinstance(b, T.DecimalType):
        scale = max(a.scale, b.scale)
        return T.DecimalType(min(38, max(a.precision - a.scale, b.precision - b.scale) + scale), scale)
    if set(names) <= {"date", "timestamp", "timestamp_ntz"}:
        return T.TimestampType() if "timestamp" in names else T.TimestampNTZType()
    if isinstance(a, T.ArrayType) and isinstance(b, T.ArrayType):
        return T.ArrayType(widened(a.elementType, b.elementType))
    if isinstance(a, T.StructType) and isinstance(b, T.StructType):
        return union_schema([a, b])
    return T.StringType()


def union_schema(schemas: list[T.StructType]) -> T.StructType:
    """All columns of the schemas, in order of first appearance, with widened types."""
    found: dict[str, T.DataType] = {}
    for s in schemas:
        for f in s.fields:
            found[f.name] = widened(found[f.name], f.dataType) if f.name in found else f.dataType
    return T.StructType([T.StructField(n, t) for n, t in found.items()])


def _as_type(c: Column, have: T.DataType, want: T.DataType) -> Column:
    """``c`` in the type ``want``; fields that a struct lacks are null."""
    if have == want:
        return c
    if isinstance(have, T.StructType) and isinstance(want, T.StructType):
        kinds = {f.name: f.dataType for f in have.fields}
        made = F.struct(*[(_as_type(c[f.name], kinds[f.name], f.dataType) if f.name in kinds else F.lit(None).cast(f.dataType)).alias(f.name)
                          for f in want.fields])
        return F.when(c.isNotNull(), made)
    if isinstance(have, T.ArrayType) and isinstance(want, T.ArrayType):
        return F.transform(c, lambda x: _as_type(x, have.elementType, want.elementType))
    if isinstance(want, T.StringType) and isinstance(have, (T.StructType, T.ArrayType, T.MapType)):
        return F.to_json(c)
    return c.cast(want)


def read_sharded(spark: SparkSession, path_glob: str, *, between: tuple[str, str] | None = None,
                 shard_col: str = "shard") -> DataFrame:
    """SRC-05: wildcard scan over many shard folders; the shard name (the
    matched file's parent folder) becomes a column.  With ``between`` the shards are
    chosen before the scan: others are never read.

    Shards may drift: the result has the columns of all of them, of the widest type
    (missing ones are null).  Shards are read in groups of one schema, and only where the
    footers do not merge as they are is each shard's own schema asked for."""
    paths = shard_files(spark, path_glob, between)
    if not paths:
        # No shard is wanted: the columns are those of the others, if any.
        others = shard_files(spark, path_glob) if between else []
        schema = spark.read.parquet(*others).schema if others else T.StructType()
        return spark.createDataFrame([], schema).withColumn(shard_col, F.lit(None).cast("string"))
    name = F.regexp_extract(F.input_file_name(), r"/([^/]+)/[^/]+$", 1)
    try:
        return spark.read.option("mergeSchema", "true").parquet(*paths).withColumn(shard_col, name)
    except Exception as e:  # noqa: BLE001  (the merge fails as an analysis or as a Spark error)
        if "MERGE" not in str(e).upper():
            raise
    folders: dict[str, list[str]] = {}
    for p in paths:
        folders.setdefault(p.rsplit("/", 1)[0], []).append(p)
    groups: dict[str, tuple[T.StructType, list[str]]] = {}
    for files in folders.values():
        try:
            found = [(spark.read.option("mergeSchema", "true").parquet(*files).schema, files)]
        except Exception as e:  # noqa: BLE001
            if "MERGE" not in str(e).upper():
                raise
            found = [(spark.read.parquet(f).schema, [f]) for f in files]
        for schema, some in found:
            groups.setdefault(schema.json(), (schema, []))[1].extend(some)
    whole = union_schema([s for s, _ in groups.values()])
    out = None
    for schema, files in groups.values():
        kinds = {f.name: f.dataType for f in schema.fields}
        part = spark.read.schema(schema).parquet(*files).withColumn(shard_col, name).select(
            *[(_as_type(F.col(f"`{f.name}`"), kinds[f.name], f.dataType) if f.name in kinds else F.lit(None).cast(f.dataType)).alias(f.name)
              for f in whole.fields], shard_col)
        out = part if out is None else out.unionByName(part)
    return out


def read_sharded_logs(spark: SparkSession, path_glob: str, suffix_between: tuple[str, str] | None = None,
                      *, shard_col: str = "shard") -> DataFrame:
    """SRC-05/06: wildcard scan of log shards with the job name flattened out of
    ``resource.labels``; ``suffix_between=(lo, hi)`` keeps shards whose name is
    within the closed string range; the others are not scanned."""
    df = read_sharded(spark, path_glob, between=suffix_between, shard_col=shard_col)
    if "resource" in df.columns:
        df = df.withColumn("job_name", F.col("resource.labels.job_name"))
    return df


def shard_between(df: DataFrame, lo: str, hi: str, col: str = "suffix") -> DataFrame:
    """SRC-06: ``suffix BETWEEN lo AND hi`` (string compare, closed); on a
    partition column this prunes folders."""
    return df.where(F.col(col).between(lo, hi))


def recent_ingest(df: DataFrame, *, as_of, days: int = 30, col: str = "ingest_date") -> DataFrame:
    """SRC-07: ``col >= as_of - days`` (``days=0``: the day itself)."""
    day = F.lit(as_of).cast("date")
    if days == 0:
        return df.where(F.col(col) == day)
    return df.where(F.col(col) >= F.date_sub(day, days))


def optional_table(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """SRC-09: a missing table reads as an empty frame of ``schema``; any other
    error surfaces (a blanket fallback would silently reprocess everything)."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as e:
        if "PATH_NOT_FOUND" in str(e) or "Path does not exist" in str(e):
            return spark.createDataFrame([], schema)
        raise


# --------------------------------------------------------------------------
# Sinks
# --------------------------------------------------------------------------

def _chapter_struct(chapters: DataFrame) -> Column:
    urls = (F.coalesce(F.col("image_urls"), F.array().cast("array<string>"))
            if "image_urls" in chapters.columns else F.array().cast("array<string>"))
    return F.struct(F.col("chapter_number").cast("string").alias("chapter_number"), "url",
                    F.col("image_count").cast("long").alias("image_count"),
                    urls.alias("image_urls"), F.col("scraped_at").alias("scraped_at"))


def write_manifests(chapters: DataFrame, path: str, *, batch: str, total_available: DataFrame | None = None,
                    scraped_at=None) -> None:
    """SNK-01: one manifest document per crawl batch (header constants + the
    batch's chapter array), written as JSON lines.  A batch is bounded by the
    caller's ``batch`` column, so no single document holds the whole table."""
    ch = _chapter_struct(chapters)
    docs = chapters.groupBy(batch).agg(
        F.array_sort(F.collect_list(ch)).alias("chapters"), F.count(F.lit(1)).alias("_n"))
    if total_available is None:
        total = F.col("_n")
    elif isinstance(total_available, DataFrame):
        total = total_available.scalar()  # one aggregate, evaluated once
    else:
        total = F.lit(total_available)
    docs.select(F.lit(CRAWL_TITLE).alias("manga"), F.lit(CRAWL_SOURCE).alias("source"),
                F.lit(CRAWL_LANGUAGE).alias("language"),
                total.cast("long").alias("total_chapters_available"),
                (F.lit(scraped_at) if scraped_at is not None else F.lit(None)).cast("string")
                .alias("scraped_at"),
                "chapters").write.mode("overwrite").json(path)


def write_manifest(chapters: DataFrame, path: str, header: dict | None = None, *,
                   batch: str | None = None) -> None:
    """SNK-01 in the target signature: ``header`` may carry ``scraped_at`` and
    ``total_chapters_available`` (a number or a one-value DataFrame).  Without
    ``batch`` the chapters are grouped into documents of 1,000 consecutive
    chapter numbers, so no document holds the whole table."""
    header = dict(header or {})
    if batch is None:
        batch = "_batch"
        # Fractional chapters have no number: they are dealt by their text instead.
        label = F.col("chapter_label") if "chapter_label" in chapters.columns else F.col("url")
        spread = F.concat(F.lit("x"), F.pmod(F.xxhash64(label), F.lit(1024)).cast("string"))
        by_number = F.floor(F.col("chapter_number").cast("double") / 1000).cast("string")
        chapters = chapters.withColumn(batch, F.coalesce(by_number, spread))
    write_manifests(chapters, path, batch=batch, total_available=header.get("total_chapters_available"),
                    scraped_at=header.get("scraped_at"))


def write_manifest_document(chapters: DataFrame, path: str, header: dict | None = None) -> None:
    """SNK-01 as **one** document written by many tasks: the part files under ``path``, joined
    in the order of their names, are one JSON text, ordered by chapter number and then by a
    hash of the chapter's JSON (no number: last).  Each chapter is a line of its own, so no task and
    no row holds the document; equal chapters all stay.  ``header`` as in ``write_manifest``.

    The comma before a line depends on whether the line is the first, so the order is fixed
    in a table first; its row numbers then deal the lines to the parts."""
    header = dict(header or {})
    spark = chapters.sparkSession
    staged = f"{ensure_checkpoint_dir(spark)}/manifest-lines-{uuid.uuid4().hex}"
    number = F.col("chapter_number").cast("double")
    rows = chapters.select(number.alias("_n"), F.to_json(_chapter_struct(chapters)).alias("line"),
                           F.monotonically_increasing_id().alias("_row"))
    # _row only tells equal lines apart, so that the ranges can part them.
    # The hash keeps the sample that finds the ranges small, however long a line is.
    ordered = rows.orderBy(F.col("_n").asc_nulls_last(), F.xxhash64("line"), "_row")
    ordered.select(F.monotonically_increasing_id().alias("at"), "line").write.parquet(staged)
    lines = spark.read.schema("at long, line string").parquet(staged)
    total = header.get("total_chapters_available")
    if total is None:
        total = lines.agg(F.count(F.lit(1)))
    head = F.to_json(F.struct(
        F.lit(CRAWL_TITLE).alias("manga"), F.lit(CRAWL_SOURCE).alias("source"), F.lit(CRAWL_LANGUAGE).alias("language"),
        (total.scalar() if isinstance(total, DataFrame) else F.lit(total)).cast("long").alias("total_chapters_available"),
        F.lit(header.get("scraped_at")).cast("string").alias("scraped_at")))
    one = spark.range(1)
    first = lines.agg(F.min("at")).scalar()
    body = lines.select("at", F.concat(F.when(F.col("at") == first, F.lit("")).otherwise(F.lit(",")), "line").alias("value"))
    begin = one.select(F.lit(-1).cast("long").alias("at"),
                       F.concat(F.regexp_replace(head, r"\}$", ""), F.lit(',"chapters":[')).alias("value"))
    end = one.select(F.lit((1 << 63) - 1).alias("at"), F.lit("]}").alias("value"))
    body.unionByName(begin).unionByName(end).orderBy("at").select("value").write.mode("overwrite").text(path)


def read_manifest_document(spark: SparkSession, path: str) -> DataFrame:
    """The chapter rows of a document that ``write_manifest_document`` wrote, in the columns of
    ``read_manifest``; its lines are read by as many tasks as there are file splits."""
    lines = spark.read.text(path)
    head = lines.where(F.col("value").endswith("[")).select(F.from_json(F.concat("value", F.lit("]}")), MANIFEST)).scalar()
    chapter = F.from_json(F.regexp_replace("value", "^,", ""), MANIFEST_CHAPTER)
    rows = lines.where(F.col("value").endswith("}") & (F.col("value") != "]}")).select(head.alias("h"), chapter.alias("c"))
    return rows.select("h.manga", "h.source", "h.language", "h.total_chapters_available",
                       F.col("h.scraped_at").alias("manifest_scraped_at"), "c.*")


def create_if_absent(spark: SparkSession, name: str, schema: T.StructType, path: str | None = None) -> None:
    """SNK-04: ``CREATE TABLE IF NOT EXISTS name (...) USING parquet``."""
    cols = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    loc = f" LOCATION '{path}'" if path else ""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({cols}) USING parquet{loc}")


def one_per_key(df: DataFrame, keys: list[str]) -> DataFrame:
    """One row per key, always the same one: that with the smallest hash of its other columns."""
    rest = [c for c in df.columns if c not in keys]
    if not rest:
        return df.distinct()
    row = F.struct(*rest)
    picked = df.groupBy(*keys).agg(F.min_by(row, F.xxhash64(F.to_json(row))).alias("_r"))
    return picked.select(*keys, *[F.col("_r")[c].alias(c) for c in rest]).select(*df.columns)


def append(df: DataFrame, path: str, keys: list[str] | None = None, *, partition_by=None) -> None:
    """SNK-02: batch append.  With ``keys`` the append is idempotent: rows whose
    key already exists at ``path`` (or repeats inside ``df``) are skipped, so
    re-running a job adds nothing.  The existing keys are read as a DataFrame
    and anti-joined; they are never collected."""
    new = df
    if keys:
        new = one_per_key(df, keys)
        spark = df.sparkSession
        try:
            done = spark.read.parquet(path)
            if partition_by:  # only the partitions that the new rows fall into are read
                done = done.join(df.select(*partition_by).distinct(), list(partition_by), "left_semi")
            done = done.select(*keys)
            cond = None
            for k in keys:
                c = new[k].eqNullSafe(done[k])
                cond = c if cond is None else cond & c
            new = new.join(done, cond, "left_anti")
        except AnalysisException as e:
            if "PATH_NOT_FOUND" not in str(e) and "Path does not exist" not in str(e):
                raise
    w = new.write.mode("append")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)


def write_ndjson(df: DataFrame, path: str) -> None:
    """NDJSON staging files (one JSON object per line)."""
    df.write.mode("overwrite").json(path)
