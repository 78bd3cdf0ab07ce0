"""Scans, sinks and text parsers."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T



# ---- scans ---------------------------------------------------------------

def csv_scan(spark: SparkSession, path: str, schema: T.StructType | str, header: bool = True,
             sep: str = ",") -> DataFrame:
    """CSV with a declared schema, so no inference pass reads the data twice."""
    return spark.read.schema(schema).options(header=header, sep=sep).csv(path)


def csv_scan_strings(spark: SparkSession, path: str, names: Sequence[str], sep: str = ",",
                     header: bool = True) -> DataFrame:
    """Every column as string; casts are left to later steps."""
    return csv_scan(spark, path, T.StructType([T.StructField(n, T.StringType()) for n in names]), header, sep)


def parquet_scan(spark: SparkSession, path: str, columns: Sequence[str] | None = None,
                 schema: str | None = None) -> DataFrame:
    reader = spark.read if schema is None else spark.read.schema(schema)
    df = reader.parquet(path)
    return df.select(*columns) if columns else df


def json_map_rows(df: DataFrame, key: str, json_col: str, value: str = "close") -> DataFrame:
    """``{epoch_ms or ISO time: value}`` per key becomes rows (key, date, value)."""
    pairs = F.from_json(F.col(json_col), "map<string,double>")
    out = df.where(F.length(F.trim(F.col(json_col))) > 0).select(key, F.explode(pairs).alias("_t", value))
    millis = F.col("_t").rlike(r"^\d+$")
    when = (F.when(millis, F.timestamp_millis(F.expr("try_cast(_t as bigint)")))
            .otherwise(F.expr("try_cast(_t as timestamp)")))
    return out.select(key, F.to_date(when).alias("date"), value)


def jsonl_scan(spark: SparkSession, path: str | list[str], schema: str, mode: str = "PERMISSIVE") -> DataFrame:
    return spark.read.schema(schema).option("mode", mode).json(path)


def jsonl_sink(df: DataFrame, path: str, compression: str = "none", mode: str = "errorifexists") -> None:
    df.write.mode(mode).option("compression", compression).json(path)


def jsonl_split_bad(spark: SparkSession, path: str, schema: str) -> tuple[DataFrame, DataFrame]:
    """(good rows, rejected lines).

    Each line is read once as text and parsed with the corrupt line kept, so
    both halves come from the same scan definition.
    """
    fields = T.StructType.fromDDL(schema)
    kept = T.StructType([*fields.fields, T.StructField("_line", T.StringType())])
    parsed = (spark.read.text(path).where(F.length(F.trim("value")) > 0)
              .select(F.from_json("value", kept, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_line"})
                      .alias("r")).select("r.*"))
    return parsed.where("_line is null").drop("_line"), parsed.where("_line is not null").select("_line")


def fetch_rows(df: DataFrame, ids: DataFrame, key: str, columns: Sequence[str]) -> DataFrame:
    """Scattered rows by key. The id list is a plain join side: the planner
    broadcasts it while it is small and shuffles it otherwise."""
    return df.select(*dict.fromkeys([key, *columns])).join(ids.select(key).distinct(), key, "left_semi").select(*columns)


def per_file_counts(spark: SparkSession, path: str) -> DataFrame:
    """Rows per file; one task per file split does the counting."""
    return (spark.read.parquet(path).select(F.input_file_name().alias("file")).groupBy("file")
            .agg(F.count(F.lit(1)).alias("n")))


def jdbc_scan(spark: SparkSession, url: str, query: str, partition_column: str, lower: int, upper: int,
              partitions: int, **options: str) -> DataFrame:
    """Parallel JDBC read: one range of ``partition_column`` per task."""
    return (spark.read.format("jdbc").options(**options)
            .option("url", url).option("dbtable", f"({query}) q")
            .option("partitionColumn", partition_column).option("lowerBound", lower)
            .option("upperBound", upper).option("numPartitions", partitions).load())


def bounded_select(spark: SparkSession, view: str, column: str, low, high, limit: int, order: str) -> DataFrame:
    """The parameterised min/max/limit statement, values bound and never pasted in."""
    return spark.sql(
        "SELECT * FROM IDENTIFIER(:view) WHERE IDENTIFIER(:col) BETWEEN :low AND :high "
        "ORDER BY IDENTIFIER(:ord) LIMIT :n",
        args={"view": view, "col": column, "low": low, "high": high, "n": limit, "ord": order})


def sql_query(spark: SparkSession, text: str, params: dict | list | None = None,
              schema: T.StructType | str | None = None, **frames: DataFrame) -> DataFrame:
    """SQL text over frames passed by name, bound parameters, optional typed result."""
    out = spark.sql(text, args=params, **frames)
    if schema is None:
        return out
    wanted = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    return out.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in wanted.fields])


def binary_files(spark: SparkSession, path: str, glob: str = "*") -> DataFrame:
    """One row per file with the parent folder as its class; bytes are read only if selected."""
    return (spark.read.format("binaryFile").option("pathGlobFilter", glob).option("recursiveFileLookup", "true")
            .load(path).withColumn("class", F.regexp_extract("path", r"([^/]+)/[^/]+$", 1)))


def text_files(spark: SparkSession, path: str, skip: str = "metadata", glob: str = "*") -> DataFrame:
    """Whole files as documents, leaving out paths with a ``skip`` part."""
    df = (spark.read.text(path, wholetext=True, recursiveFileLookup=True, pathGlobFilter=glob)
          .withColumn("path", F.input_file_name()))
    return df.where(~F.col("path").contains(f"/{skip}")) if skip else df


# ---- line formats ----------------------------------------------------------

def parse_series_lines(lines: DataFrame, col: str = "value") -> DataFrame:
    """``v1,...,vN:label`` data lines to (series, label); header and comment lines are dropped."""
    text = F.trim(F.col(col))
    data = lines.where((F.length(text) > 0) & ~text.rlike("^[@#%]") & text.contains(":"))
    text = F.trim(F.col(col))
    return data.select(
        F.transform(F.split(F.regexp_extract(text, r"^(.*):[^:]*$", 1), ","),
                    lambda v: v.try_cast("double")).alias("series"),
        F.regexp_extract(text, r":([^:]*)$", 1).alias("label"))


def widen_series(df: DataFrame, width: int, col: str = "series") -> DataFrame:
    """Columns t0..t{width-1} out of the array."""
    return df.select(*[F.get(col, F.lit(i)).alias(f"t{i}") for i in range(width)], "label")


def parse_fixed_width(lines: DataFrame, spans: dict[str, tuple[int, int, str]], col: str = "value") -> DataFrame:
    """``{name: (start, end, type)}`` character spans; lines that are short or do not parse are dropped."""
    longest = max(end for _, end, _ in spans.values())
    cut = {
        name: F.trim(F.substring(F.col(col), start + 1, end - start)).try_cast(kind)
        for name, (start, end, kind) in spans.items()
    }
    out = lines.where(F.length(col) >= longest).select(*[c.alias(n) for n, c in cut.items()])
    return out.dropna(subset=[n for n, (_, _, kind) in spans.items() if kind != "string"])


def fasta_scan(spark: SparkSession, path: str) -> DataFrame:
    """(record_id, sequence) from ``>``-headed files, split on the record mark."""
    # A mark inside a header line is part of it: records start at a mark at the start of a line.
    records = spark.read.option("lineSep", "\n>").text(path).where(F.length(F.trim("value")) > 0)
    records = records.select(F.regexp_replace("value", "^\\s*>", "").alias("value"))
    head = F.substring_index("value", "\n", 1)
    body = F.expr("substring(value, length(substring_index(value, '\n', 1)) + 2)")
    return records.select(F.trim(head).alias("record_id"), F.regexp_replace(body, r"\s", "").alias("sequence"))


# ---- sinks -----------------------------------------------------------------

def shard_sink(df: DataFrame, path: str, max_records: int, fmt: str = "json", mode: str = "errorifexists") -> None:
    """Files of at most ``max_records`` records."""
    df.write.mode(mode).format(fmt).option("maxRecordsPerFile", max_records).save(path)


def records_per_shard(max_bytes: int, avg_record_bytes: float) -> int:
    """Record limit that keeps a shard near a byte target."""
    return max(1, int(max_bytes // max(avg_record_bytes, 1.0)))


def seeded_shuffle(df: DataFrame, key: str, seed: int) -> DataFrame:
    """Repeatable full shuffle: a range sort on a hash of the key."""
    return df.orderBy(F.xxhash64(F.col(key), F.lit(seed)), key)


def append_chunks(chunks: Iterable[DataFrame], path: str) -> None:
    """Create the table with the first chunk, append the rest."""
    for chunk in chunks:
        chunk.write.mode("append").parquet(path)


def external_table(df: DataFrame, name: str, path: str) -> DataFrame:
    """Create or overwrite an external Parquet table and return it."""
    df.write.mode("overwrite").format("parquet").option("path", path).saveAsTable(name)
    return df.sparkSession.table(name)


def batch_insert(spark: SparkSession, columns: dict[str, list], schema: str, path: str) -> None:
    """Equal-length column lists bound as rows and appended to a staging table."""
    if len({len(v) for v in columns.values()}) > 1:
        raise ValueError("column lists differ in length")
    spark.createDataFrame(list(zip(*columns.values())), schema).write.mode("append").parquet(path)


def partitioned_sink(df: DataFrame, path: str, keys: Sequence[str], mode: str = "overwrite",
                     max_records: int = 5_000_000) -> None:
    """Directory per key value. Rows are spread over tasks as they come, so a
    key with most rows is written by many tasks, each file bounded in rows."""
    df.write.mode(mode).partitionBy(*keys).option("maxRecordsPerFile", max_records).parquet(path)


# ---- batch-wise reading ----------------------------------------------------

def map_batches(df: DataFrame, fn: Callable[[pa.RecordBatch], pa.RecordBatch], schema: str) -> DataFrame:
    """Apply ``fn`` to bounded Arrow record batches."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield fn(batch)
    return df.mapInArrow(run, schema)


def batch_sums(df: DataFrame, col: str) -> DataFrame:
    """(rows, total) per Arrow batch of one numeric column."""
    def one(batch: pa.RecordBatch) -> pa.RecordBatch:
        import pyarrow.compute as pc
        total = pc.sum(batch.column(0)).as_py() or 0.0
        return pa.RecordBatch.from_arrays([pa.array([batch.num_rows], pa.int64()), pa.array([float(total)])],
                                          names=["rows", "total"])
    return map_batches(df.select(F.col(col).cast("double")), one, "rows long, total double")


# ---- fingerprints ----------------------------------------------------------

def content_hash(df: DataFrame) -> DataFrame:
    """Order-free fingerprint of a frame: sum of row hashes and row count."""
    return df.agg(F.sum(F.xxhash64(*[F.col(c) for c in df.columns]).cast("decimal(38,0)")).alias("row_hash_sum"),
                  F.count(F.lit(1)).alias("n_rows"))


def sha256(col: Column | str) -> Column:
    return F.sha2(F.col(col) if isinstance(col, str) else col, 256)


def with_fallback(primary: DataFrame, secondary: DataFrame, limit: int) -> DataFrame:
    """``primary`` if it has a row, else up to ``limit`` rows of ``secondary``."""
    return secondary.limit(limit) if primary.isEmpty() else primary
