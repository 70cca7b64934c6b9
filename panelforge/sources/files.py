"""Table sources and sinks.

Parquet is the default format (vectorised, column-pruned, predicate
push-down).  CSV is read with an explicit schema whenever one is known;
``.gz`` files are read natively (one split per file).
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


def table_path(sf_dir: str, name: str) -> str:
    return f"{sf_dir.rstrip('/')}/{name}.parquet"


def read_table(spark: SparkSession, sf_dir: str, name: str,
               columns: Sequence[str] | None = None) -> DataFrame:
    """Parquet scan of one table, optionally projected (pruned at the scan)."""
    df = spark.read.parquet(table_path(sf_dir, name))
    return df.select(*columns) if columns else df


def read_csv(spark: SparkSession, path: str | list[str], schema: T.StructType | str | None = None,
             header: bool = True, na_tokens: Iterable[str] = ("",), sep: str = ",",
             infer: bool = False) -> DataFrame:
    """CSV scan of a file, a directory, a glob or a list of paths.

    Spark raises ``PATH_NOT_FOUND`` itself when nothing matches.  Without a
    schema every column is text unless ``infer`` asks for type inference (an
    extra pass over the data; avoid at scale).  Extra
    missing-value tokens (pandas turns ``NA`` into missing, Spark does not)
    are mapped to NULL after the read.
    """
    reader = spark.read.option("header", header).option("sep", sep).option("mode", "FAILFAST")
    tokens = list(na_tokens)
    # With more tokens a typed column is read as text, mapped, then cast (a malformed value still fails the read).
    target = None
    if schema is not None and tokens[1:]:
        target = schema if isinstance(schema, T.StructType) else T._parse_datatype_string(schema)
        schema = T.StructType([T.StructField(f.name, T.StringType()) for f in target.fields])
    reader = reader.option("nullValue", tokens[0] if tokens else "")
    if schema is not None:
        reader = reader.schema(schema)
    elif infer:
        reader = reader.option("inferSchema", True)
    df = reader.csv(path)
    extra = tokens[1:]
    if extra:
        from pyspark.sql import functions as F
        df = df.select(*[
            F.when(F.col(f"`{f.name}`").isin(extra), F.lit(None)).otherwise(F.col(f"`{f.name}`")).alias(f.name)
            if isinstance(f.dataType, T.StringType) else F.col(f"`{f.name}`")
            for f in df.schema.fields])
    if target is not None:
        df = df.select(*[F.col(f"`{f.name}`").cast(f.dataType).alias(f.name) for f in target.fields])
    return df


def with_input_order(df: DataFrame, out: str = "ord") -> DataFrame:
    """Q5/Q6: a numeric ordering key that follows the rows' position in the input files.

    Must be applied directly on a file scan.  The key packs (number of the file by path, as a
    sorted glob gives it; start of the split in the file; place of the row in its task) into one
    ``decimal(38,0)`` of 31 digits.  A split is read in file order by one task, so the key is the
    same when a task is repeated, and being a number it keeps ``min_by`` / ``max`` on hash
    aggregates.  The table of file numbers has one row a file and is joined by path.
    """
    from pyspark.sql import functions as F

    from ..functions.exprs import pack_order_key

    def plain(path):  # scheme:/path and scheme:///path name one file
        return F.regexp_replace(path, "^([A-Za-z0-9+.-]+):/+", "$1:/")

    spark = df.sparkSession
    files = spark.createDataFrame([(f, n) for n, f in enumerate(sorted(df.inputFiles()))], "_path string, _file long")
    # The low 33 bits of the id count the rows of a task.
    row = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    placed = df.select("*", plain(F.col("_metadata.file_path")).alias("_of"), F.col("_metadata.file_block_start").alias("_block"), row.alias("_row"))
    known = placed.join(files.select(plain(F.col("_path")).alias("_of"), "_file"), "_of", "left")
    number = F.when(F.col("_file").isNotNull(), F.col("_file")).otherwise(F.raise_error(F.concat(F.lit("not an input file: "), "_of")).cast("long"))
    return known.select(*[F.col(f"`{c}`") for c in df.columns], pack_order_key([(number, 7), ("_block", 13), ("_row", 11)]).alias(out))


def write_table(df: DataFrame, path: str, fmt: str = "parquet", mode: str = "overwrite",
                partition_by: Sequence[str] | None = None, header: bool = True) -> None:
    """Write Parquet or CSV; the writer creates the folder."""
    w = df.write.mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    if fmt == "parquet":
        w.parquet(path)
    elif fmt == "csv":
        w.option("header", header).csv(path)
    else:
        raise ValueError(f"unsupported format {fmt!r}")


def write_ordered(df: DataFrame, path: str, by: Sequence[str], fmt: str = "parquet", mode: str = "overwrite",
                  partition_by: Sequence[str] | None = None, partitions: int | None = None, header: bool = True) -> None:
    """O2: a total-order sink: rows sorted by ``by`` over the files in the order of their names.

    Rows are dealt into ranges of ``by`` (inside the ``partition_by`` folders), each range is sorted by
    one task and written as one numbered file, so reading a folder's files by name gives the whole order.
    No task holds more than its range.
    """
    keys = [*(partition_by or ()), *by]
    n = partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    write_table(df.repartitionByRange(n, *keys).sortWithinPartitions(*keys), path, fmt, mode, partition_by, header)


def literal_names(df: DataFrame, mapping: dict[str, str]) -> DataFrame:
    """Rename internal names (``q10``) to export names (``0.1``) right before a write."""
    return df.select(*[df[f"`{c}`"].alias(mapping.get(c, c)) for c in df.columns])
