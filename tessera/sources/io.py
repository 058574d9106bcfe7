"""Sources and sinks (SRC*, SINK*)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import ensure_checkpoint_dir


def read_table(spark: SparkSession, name_or_path: str) -> DataFrame:
    """Full scan of a catalog table or a Parquet path (SRC1).  Column pruning
    and filter pushdown reach the scan from whatever the caller selects."""
    if "/" in name_or_path:
        return spark.read.parquet(name_or_path)
    return spark.table(name_or_path)


def read_reviews_csv(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """CSV with a header whose text fields may hold quotes and line breaks
    (SRC2).  Such a file cannot be cut, so each is read by one task: export
    large data as many files."""
    return (spark.read.option("header", True).option("multiLine", True)
            .option("quote", '"').option("escape", '"').schema(schema).csv(path))


def write_reviews_csv(df: DataFrame, path: str) -> None:
    (df.write.mode("overwrite").option("header", True).option("quote", '"')
     .option("escape", '"').csv(path))


def read_keyed_records(spark: SparkSession, path: str, fields, key: str = "id",
                       whole_file: bool = False) -> DataFrame:
    """Keyed-record text: ``{id: {field: text, ...}, ...}`` in single- or
    double-quoted form, one row per id (SRC3).

    By default every line is one such mapping (files written by
    ``write_keyed_records``), so a large input splits into many tasks.
    ``whole_file`` reads each file as one document, for hand-written,
    pretty-printed files."""
    struct = ", ".join(f"`{f}`: STRING" for f in fields)
    schema = f"MAP<STRING, STRUCT<{struct}>>"
    raw = spark.read.text(path, wholetext=whole_file)
    parsed = raw.select(F.explode(F.from_json("value", schema,
                                              {"allowSingleQuotes": "true"})).alias(key, "r"))
    return parsed.select(key, *[F.col("r")[f].alias(f) for f in fields])


def write_keyed_mappings(df: DataFrame, path: str, key: str, per_file: int = 1000) -> None:
    """Pretty-printed mappings of about ``per_file`` records, one to a file, as
    hand-kept files look; read with ``whole_file=True``."""
    files = max(1, -(-df.count() // per_file))
    rest = F.struct(*[F.col(c) for c in df.columns if c != key])
    entry = F.struct(F.col(key).cast("string"), rest)
    one = (df.groupBy(F.pmod(F.xxhash64(key), F.lit(files)).alias("_f"))
           .agg(F.map_from_entries(F.collect_list(entry)).alias("m")))
    (one.select(F.to_json("m", {"pretty": "true"}).alias("value")).write.mode("overwrite")
     .option("maxRecordsPerFile", 1).text(path))


def write_keyed_records(df: DataFrame, path: str, key: str) -> None:
    """One ``{id: {...}}`` mapping per line (JSON text)."""
    rest = [c for c in df.columns if c != key]
    line = F.to_json(F.create_map(F.col(key), F.struct(*rest)))
    df.select(line.alias("value")).write.mode("overwrite").text(path)


def read_labelled_dir(spark: SparkSession, root: str, glob: str = "*") -> DataFrame:
    """Every file under ``root/<label>/…`` with its label (SRC4).

    For files that are one record each, such as images: ``binaryFile`` lists
    and reads them in parallel, one file per cell (2 GiB at most; see
    ``read_labelled_lines`` for text).  The label is the parent folder name (a
    ``key=value`` folder gives its value)."""
    df = (spark.read.format("binaryFile").option("recursiveFileLookup", "true")
          .option("pathGlobFilter", glob).load(root))
    parent = F.element_at(F.split("path", "/"), -2)
    return df.withColumn("label", F.regexp_replace(parent, r"^[^=]*=", ""))


def read_labelled_lines(spark: SparkSession, root: str, glob: str = "*") -> DataFrame:
    """Every line of the text files under ``root/<label>/…`` as ``value`` with
    its label (SRC4).  Files are read in splits, so a label of any size is
    read by many tasks; the label is the parent folder name (a ``key=value``
    folder gives its value)."""
    lines = (spark.read.option("recursiveFileLookup", "true").option("pathGlobFilter", glob)
             .text(root))
    folder = F.element_at(F.split(F.col("_metadata.file_path"), "/"), -2)
    return lines.select(F.regexp_replace(F.url_decode(folder), r"^[^=]*=", "").alias("label"), "value")


def write_records(df: DataFrame, path: str) -> None:
    """Write all records, one JSON object per line (SINK1)."""
    df.write.mode("overwrite").json(path)


def write_labels(df: DataFrame, label: str, path: str) -> None:
    """Sorted distinct labels, one per line (SINK2).  The sort is a range
    partitioning, so part files concatenate in label order."""
    (df.select(F.col(label).cast("string").alias("value")).distinct()
     .orderBy("value").write.mode("overwrite").text(path))


def materialize(df: DataFrame, name: str, schema: T.StructType | str) -> DataFrame:
    """Temp table with declared column types (SINK3): cast-select to the
    schema, cut the lineage with a reliable checkpoint in the shared
    checkpoint folder, register as a temp view and read it back.  Columns
    match by position, as in an INSERT; another number of columns than the
    schema's is an error."""
    spark = df.sparkSession
    if isinstance(schema, str):
        schema = T.StructType.fromDDL(schema)
    if len(df.columns) != len(schema.fields):
        raise ValueError(f"{len(df.columns)} columns for a schema of {len(schema.fields)}")
    cast = df.select(*[F.col(f"`{c}`").cast(f.dataType).alias(f.name)
                       for c, f in zip(df.columns, schema.fields)])
    ensure_checkpoint_dir(spark)
    stored = cast.checkpoint(eager=True)
    stored.createOrReplaceTempView(name)
    return spark.table(name)


def publish_view(df: DataFrame, name: str) -> DataFrame:
    """Named view over a query, then read it (SINK4)."""
    df.createOrReplaceTempView(name)
    return df.sparkSession.table(name)
