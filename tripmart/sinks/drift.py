"""Files whose columns changed over time, as one table.

Files are grouped by the schema their footers state, each group is one scan, and the scans are
widened to a common schema and put together by name. Names that differ in case only are one column.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripmart import paths
from tripmart.functions.widening import as_type, widened

# Footers that the driver opens at a time.
FOOTER_THREADS = 16


def to_schema(df: DataFrame, schema: T.StructType) -> DataFrame:
    """``df`` with the columns of ``schema``; those it lacks are NULL."""
    own = {f.name.lower(): f for f in df.schema}
    columns = []
    for field in schema:
        have = own.get(field.name.lower())
        value = F.lit(None).cast(field.dataType) if have is None else as_type(df[f"`{have.name}`"], have.dataType, field.dataType)
        columns.append(value.alias(field.name))
    return df.select(*columns)


def file_schemas(spark: SparkSession, files: Sequence[str]) -> dict[str, T.StructType]:
    """Schema of each Parquet file, from its footer; equal footers are converted once.

    What reaches the driver is a schema per file, as a listing brings a name per file.
    """
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    no_rows = jvm.org.apache.parquet.format.converter.ParquetMetadataConverter.SKIP_ROW_GROUPS
    reader = jvm.org.apache.parquet.hadoop.ParquetFileReader

    @inheritable_thread_target(spark)
    def footer(file: str) -> tuple[str, str]:
        # a listing gives addresses with escapes
        place = jvm.org.apache.hadoop.fs.Path(jvm.java.net.URI(file))
        meta = reader.readFooter(conf, place, no_rows).getFileMetaData()
        spark_schema = meta.getKeyValueMetaData().get("org.apache.spark.sql.parquet.row.metadata")
        return meta.getSchema().toString(), spark_schema or ""

    with ThreadPoolExecutor(FOOTER_THREADS) as pool:
        found = list(pool.map(footer, files))
    kinds: dict[tuple[str, str], T.StructType] = {}
    for file, kind in zip(files, found, strict=True):
        if kind not in kinds:
            kinds[kind] = spark.read.parquet(paths.plain(spark, file)).schema
    return {file: kinds[kind] for file, kind in zip(files, found, strict=True)}


def batch_schemas(spark: SparkSession, folders: Sequence[str], fmt: str = "parquet") -> dict[str, T.StructType]:
    """Schema of each folder that one write made: that of any one of its files."""
    return {folder: spark.read.format(fmt).load(folder).schema for folder in folders}


def scan_grouped(
    spark: SparkSession,
    schemas: Mapping[str, T.StructType],
    fmt: str = "parquet",
    base: str | None = None,
) -> DataFrame:
    """The files or folders of ``schemas`` as one table of the widened schema.

    One scan per distinct schema, so the plan grows with the schemas and not with the files. With
    ``base``, partition directories below it are columns.
    """
    groups: dict[str, list[str]] = {}
    kinds: dict[str, T.StructType] = {}
    for place, schema in schemas.items():
        # NULL or not is no difference between files
        kind = T.StructType([T.StructField(f.name, f.dataType) for f in schema])
        groups.setdefault(kind.json(), []).append(place)
        kinds[kind.json()] = kind
    target = widened(list(kinds.values()))

    def scan(key: str) -> DataFrame:
        reader = spark.read.format(fmt).schema(kinds[key])
        if base is not None:
            reader = reader.option("basePath", base)
        df = reader.load(groups[key])
        own = {f.name.lower() for f in target}
        parts = [c for c in df.columns if c.lower() not in own]
        schema = T.StructType([*target, *(df.schema[c] for c in parts)])
        return to_schema(df, schema)

    return reduce(DataFrame.unionByName, map(scan, groups))


def scan_drifting(spark: SparkSession, path: str) -> DataFrame:
    """All Parquet files below ``path`` (a file, a folder or a pattern) as one table."""
    plain = spark.read.parquet(path)
    files = sorted(plain.inputFiles())
    if len(files) < 2:
        return plain
    schemas = file_schemas(spark, files)
    if len({s.json() for s in schemas.values()}) == 1:
        return plain
    base = path if paths.is_directory(spark, path) else None
    return scan_grouped(spark, {paths.plain(spark, f): s for f, s in schemas.items()}, base=base)
