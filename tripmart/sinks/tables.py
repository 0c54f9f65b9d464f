"""Table writes without a transactional format.

A replaced table is a folder of version directories plus a small pointer file that names
the published one. Writing a version and publishing it are two steps, so a version can be
audited first and a failed job leaves readers on the old one; as long as nothing was ever
published, the table is missing. A publication names the version it was made from and fails
if another one was published since. An append-only table is a folder with one directory per
origin, and below it one directory per batch; a complete batch is never written again.
"""

from __future__ import annotations

import json
import math
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tripmart import paths
from tripmart.sinks.clustering import curve_key
from tripmart.sinks.drift import batch_schemas, scan_grouped

POINTER = "_current"
SCHEMA = "_schema"
# Pointers of tables that are published together, in the folder above theirs.
GROUP = "_tables"
# The data files of a version that takes files of earlier ones over, one a line.
FILES = "_files"

# Formats that replace data and schema in one transaction of their own.
TRANSACTIONAL = {"delta"}
# Fixed value: the partition directory of NULL.
NULL_PARTITION = "__HIVE_DEFAULT_PARTITION__"

# What the name of a compacted batch begins with.
COMPACTED = "compacted-"
TARGET_FILE_BYTES = 256 * 1024 * 1024
# A clustered file is sorted by one task, which holds its rows uncompressed: so many at most, about.
SORTED_ROWS = 2_000_000


#: Stands for whatever version is the current one.
ANY = object()


class PublishConflict(Exception):
    """Another version was published since the one this job read."""


class MissingTable(Exception):
    """A table without a published version."""


def version_path(path: str, run_id: str) -> str:
    return f"{path.rstrip('/')}/v={run_id}"


def _group(spark: SparkSession, root: str) -> dict:
    place = f"{root.rstrip('/')}/{GROUP}"
    return json.loads(paths.read_text(spark, place)) if paths.exists(spark, place) else {}


def _pointer(spark: SparkSession, path: str) -> dict:
    root, _, name = path.rstrip("/").rpartition("/")
    together = _group(spark, root).get("tables", {})
    if name in together:
        return together[name]
    pointer = f"{path.rstrip('/')}/{POINTER}"
    return json.loads(paths.read_text(spark, pointer)) if paths.exists(spark, pointer) else {}


def _put_pointer(spark: SparkSession, path: str, content: dict) -> None:
    root, _, name = path.rstrip("/").rpartition("/")
    group = _group(spark, root)
    if name in group.get("tables", {}):
        group["tables"][name] = content
        paths.replace_text(spark, f"{root}/{GROUP}", json.dumps(group))
    else:
        paths.replace_text(spark, f"{path.rstrip('/')}/{POINTER}", json.dumps(content))


def published(spark: SparkSession, path: str) -> str | None:
    """The name of the published version, if there is one."""
    return _pointer(spark, path).get("version")


def resolve(spark: SparkSession, path: str) -> str:
    """The directory that holds the published version, or ``path`` for a plain table.

    A folder of versions of which none is published holds no table.
    """
    version = published(spark, path)
    if version is not None:
        return version_path(path, version)
    if paths.exists(spark, path) and paths.is_directory(spark, path):
        if any(name.startswith("v=") for name in paths.list_names(spark, path)):
            raise MissingTable(f"{path} has no published version")
    return path


def publish(
    spark: SparkSession,
    path: str,
    run_id: str,
    over: object = ANY,
    parts: dict[str, str] | None = None,
    notes: dict | None = None,
    files: Sequence[str] | None = None,
) -> None:
    """Make a written version the current one.

    ``over`` is the version the new one was made from (None: there was none); if another is
    current by now, `PublishConflict` is raised. The look and the write are two steps, so two
    jobs that publish in the same instant still need a lock of their scheduler. The pointer
    keeps the order of publications. ``parts`` says of each partition in which version it is,
    where that is not ``run_id``'s for all. ``notes`` are kept with the version (see `notes_of`):
    what it was made from, for a job that goes on from there. ``files`` lists the version's data
    files below ``path``, where it takes some of earlier versions over.
    """
    change = Publication(run_id, over, parts, notes, files)
    _put_pointer(spark, path, _next_pointer(spark, path, change))


@dataclass
class Publication:
    """What `publish` is told about one table."""

    run_id: str
    over: object = ANY
    parts: dict[str, str] | None = None
    notes: dict | None = None
    files: Sequence[str] | None = None


def _next_pointer(spark: SparkSession, path: str, change: Publication) -> dict:
    pointer = _pointer(spark, path)
    current, run_id = pointer.get("version"), change.run_id
    if change.over is not ANY and change.over != current:
        raise PublishConflict(f"{path}: {run_id} was made from {change.over}, but {current} is current")
    earlier = [v for v in [*pointer.get("earlier", []), current] if v not in (None, run_id)]
    content = {"version": run_id, "earlier": earlier}
    if change.parts:
        content["parts"] = change.parts
    if change.notes:
        content["notes"] = change.notes
    if change.files is not None:
        listed = f"{version_path(path, run_id)}/{FILES}"
        paths.replace_text(spark, listed, "\n".join(change.files))
        content["by_file"] = sorted({file.split("/")[0].removeprefix("v=") for file in change.files})
    return content


def publish_together(spark: SparkSession, root: str, changes: Mapping[str, Publication]) -> None:
    """Publish versions of several tables below ``root`` in one step.

    One file names the versions of all tables, and it is replaced as a whole: readers see all old
    or all new ones, whenever the job dies. Each table's ``over`` is checked first. Tables that were
    published on their own before move into that file, and stay there.
    """
    root = root.rstrip("/")
    group = _group(spark, root)
    pointers = {name: _next_pointer(spark, f"{root}/{name}", change) for name, change in changes.items()}
    group["tables"] = group.get("tables", {}) | pointers
    paths.replace_text(spark, f"{root}/{GROUP}", json.dumps(group))


def notes_of(spark: SparkSession, path: str) -> dict:
    """What the published version was published with."""
    return _pointer(spark, path).get("notes", {})


def load_version(
    spark: SparkSession, folder: str, fmt: str = "parquet", schema: StructType | None = None
) -> DataFrame:
    """One version, published or not."""
    return _reader(spark, folder, fmt, schema).load(folder)


def _reader(spark: SparkSession, folder: str, fmt: str, schema: StructType | None):
    """A reader with the schema the version was written with; no file may say it if it is empty."""
    kept = f"{folder}/{SCHEMA}"
    if schema is None and paths.exists(spark, kept):
        schema = StructType.fromJson(json.loads(paths.read_text(spark, kept)))
    reader = spark.read.format(fmt)
    return reader if schema is None else reader.schema(schema)


def load_published(
    spark: SparkSession, path: str, fmt: str = "parquet", schema: StructType | None = None
) -> DataFrame:
    """The published version, whose partitions may be in directories of several versions."""
    path = path.rstrip("/")
    current, pointer = resolve(spark, path), _pointer(spark, path)
    if "by_file" in pointer:
        return load_files(spark, path, current_files(spark, path), fmt, schema)
    parts = pointer.get("parts")
    if not parts:
        return _reader(spark, current, fmt, schema).load(current)
    return _load_parts(spark, path, current, parts, fmt, schema)


def current_files(spark: SparkSession, path: str) -> list[str]:
    """The published version's data files, as places below ``path``."""
    path = path.rstrip("/")
    if "by_file" in _pointer(spark, path):
        text = paths.read_text(spark, f"{resolve(spark, path)}/{FILES}")
        return text.split("\n") if text else []
    return paths.below(spark, path, load_published(spark, path).inputFiles())


def load_files(
    spark: SparkSession,
    path: str,
    files: Sequence[str],
    fmt: str = "parquet",
    schema: StructType | None = None,
) -> DataFrame:
    """Some data files of the published version, partition columns included."""
    reader = _reader(spark, resolve(spark, path), fmt, schema)
    found = reader.option("basePath", path).load([f"{path}/{file}" for file in files])
    return found.drop("v")


def _load_parts(
    spark: SparkSession,
    path: str,
    current: str,
    parts: dict[str, str],
    fmt: str = "parquet",
    schema: StructType | None = None,
) -> DataFrame:
    reader = _reader(spark, current, fmt, schema)
    folders = [f"{version_path(path, version)}/{name}" for name, version in parts.items()]
    # the versions' directories look like one more partition column
    return reader.option("basePath", path).load(folders).drop("v")


def load_written(
    spark: SparkSession, path: str, run_id: str, parts: dict[str, str], fmt: str = "parquet"
) -> DataFrame:
    """A version of ``parts`` that is written and not published yet."""
    path = path.rstrip("/")
    return _load_parts(spark, path, version_path(path, run_id), parts, fmt)


def current_parts(spark: SparkSession, path: str) -> dict[str, str]:
    """The published version's partition directories, each with the version that holds it."""
    pointer = _pointer(spark, path)
    if "by_file" in pointer:
        raise ValueError(f"{path} is kept by file, not by partition")
    if "parts" in pointer:
        return pointer["parts"]
    base = published(spark, path)
    return {name: base for name in _partitions(spark, version_path(path, base))} if base else {}


def load_partitions(
    spark: SparkSession,
    path: str,
    column: str,
    values: Sequence[object],
    fmt: str = "parquet",
    parts: dict[str, str] | None = None,
    run_id: str | None = None,
) -> DataFrame | None:
    """Some partitions of the published version; no other directory is listed or read.

    With ``parts`` and ``run_id``, of a version that is not published yet. ``None`` if none of
    the partitions is there.
    """
    path = path.rstrip("/")
    held = current_parts(spark, path) if parts is None else parts
    names = {partition_name(column, value) for value in values}
    some = {name: version for name, version in held.items() if name in names}
    if not some:
        return None
    current = resolve(spark, path) if run_id is None else version_path(path, run_id)
    return _load_parts(spark, path, current, some, fmt)


def bloom_options(columns: Sequence[str]) -> dict[str, str]:
    """Writer options for a Bloom filter of each column, as large as its file's values need."""
    options = {f"parquet.bloom.filter.enabled#{name}": "true" for name in columns}
    return options | ({"parquet.bloom.filter.adaptive.enabled": "true"} if columns else {})


def _write_partitions(
    df: DataFrame, target: str, fmt: str, by: Sequence[str], bloom: Sequence[str] = ()
) -> None:
    writer = df.write.mode("overwrite").format(fmt).options(**bloom_options(bloom))
    writer.partitionBy(*by).save(target)
    fields = [f for f in df.schema if f.name not in by] + [df.schema[name] for name in by]
    paths.replace_text(df.sparkSession, f"{target}/{SCHEMA}", StructType(fields).json())


def _partitions(spark: SparkSession, folder: str) -> list[str]:
    """Names of the partition directories of a version."""
    if not paths.exists(spark, folder):
        return []
    return [name for name in paths.list_names(spark, folder) if "=" in name]


def partition_columns(spark: SparkSession, path: str) -> list[str]:
    """What the published version is partitioned by."""
    pointer = _pointer(spark, path)
    if "by_file" in pointer:
        held = [name for file in current_files(spark, path) for name in file.split("/")[1:-1]]
    else:
        held = [*pointer.get("parts", {}), *_partitions(spark, resolve(spark, path))]
    return list(dict.fromkeys(name.partition("=")[0] for name in held))


def partition_name(column: str, value: object) -> str:
    return f"{column}={NULL_PARTITION if value is None else value}"


def check_names(df: DataFrame) -> None:
    """Refuse a column that the directories of several versions would hide."""
    if "v" in map(str.lower, df.columns):
        raise ValueError("a table that spans versions cannot have a column named 'v'")


def replace_partitions(
    df: DataFrame,
    path: str,
    run_id: str,
    column: str,
    touched: Sequence[object],
    fmt: str = "parquet",
    publish_now: bool = True,
    notes: dict | None = None,
    balanced: bool = False,
) -> dict[str, str]:
    """Write the rows of the ``touched`` partitions anew; all others stay the files they are.

    ``df`` holds all rows these partitions shall have. Returns the parts to publish; they are
    published at once, over the version they extend, unless ``publish_now`` is off. ``balanced``
    is as in `overwrite`.
    """
    check_names(df)
    spark, base = df.sparkSession, published(df.sparkSession, path)
    old = current_parts(spark, path)
    target = version_path(path, run_id)
    _write_partitions(df if balanced else df.hint("rebalance", F.col(column)), target, fmt, [column])
    gone = {partition_name(column, value) for value in touched}
    parts = {name: version for name, version in old.items() if name not in gone}
    parts |= {name: run_id for name in _partitions(spark, target)}
    if publish_now:
        publish(spark, path, run_id, base, parts, notes)
    return parts


def overwrite(
    df: DataFrame,
    path: str,
    run_id: str,
    fmt: str = "parquet",
    partition_by: Sequence[str] = (),
    publish_now: bool = True,
    over: object = ANY,
    bloom: Sequence[str] = (),
    balanced: bool = False,
) -> str:
    """Replace a table, schema included; returns the path of the new version.

    The table may be an input of ``df``: the old version is not touched. With
    ``partition_by``, rows are first rebalanced on those columns, so that a partition gets
    few files and a partition far larger than the others is still split over many tasks; rows that
    lie that way already (``balanced``) do not move. ``bloom`` names columns whose values every file
    keeps a Bloom filter of (Parquet).
    """
    if partition_by and not balanced:
        df = df.hint("rebalance", *[F.col(c) for c in partition_by])
    writer = df.write.mode("overwrite").format(fmt).options(**bloom_options(bloom))
    if fmt in TRANSACTIONAL:
        if partition_by:
            writer = writer.partitionBy(*partition_by)
        writer.option("overwriteSchema", "true").save(path)
        return path
    target = version_path(path, run_id)
    if partition_by:
        _write_partitions(df, target, fmt, partition_by, bloom)
    else:
        writer.save(target)
    if publish_now:
        publish(df.sparkSession, path, run_id, over)
    return target


def drop_old_versions(spark: SparkSession, path: str, keep: int = 1) -> list[str]:
    """Delete versions published before the current one except the ``keep`` last of them.

    The pointer knows their order. Versions that were never published are left alone: a run
    may be auditing one. Readers that opened a deleted version before fail, so keep as many as
    jobs overlap.
    """
    path = path.rstrip("/")
    pointer = _pointer(spark, path)
    earlier = pointer.get("earlier", [])
    used = {*pointer.get("parts", {}).values(), *pointer.get("by_file", [])}
    old = [v for v in earlier[: max(0, len(earlier) - keep)] if v not in used]
    dropped = []
    for version in old:
        target = version_path(path, version)
        if paths.exists(spark, target):
            paths.delete(spark, target)
            dropped.append(target)
    if dropped:
        pointer["earlier"] = [v for v in earlier if v not in old]
        _put_pointer(spark, path, pointer)
    return dropped


def _complete(spark: SparkSession, folder: str) -> bool:
    return paths.exists(spark, f"{folder}/_SUCCESS")


def append_merge(
    df: DataFrame, path: str, origin: str, batch: str, fmt: str = "parquet"
) -> str:
    """Append one batch of one origin, once.

    A batch that is complete stays as it is, so a repeated job adds and changes nothing; a
    batch that a job died in is written anew, and readers do not see it before it is complete.
    """
    if fmt in TRANSACTIONAL:
        df.write.mode("append").format(fmt).option("mergeSchema", "true").save(path)
        return path
    target = f"{path.rstrip('/')}/origin={origin}/batch={batch}"
    if not _complete(df.sparkSession, target) and not _replaced(df.sparkSession, path, origin, batch):
        df.write.mode("overwrite").format(fmt).save(target)
    return target


def batch_names(spark: SparkSession, path: str, origin: str) -> list[str]:
    """Names of all complete batches ever appended to an origin, compacted away or not."""
    now = [folder.rpartition("/batch=")[2] for folder in batches(spark, path, origin)]
    return sorted({*now, *_compacted(spark, path, origin).get("replaces", [])})


def pending(spark: SparkSession, path: str, origin: str, done: Sequence[str]) -> list[str]:
    """Folders of the batches that hold rows of batches other than ``done``."""
    known, found = set(done), []
    for folder in batches(spark, path, origin):
        name = folder.rpartition("/batch=")[2]
        held = {name}
        if name.startswith(COMPACTED):
            held = set(_compacted(spark, path, origin).get("replaces", []))
        if name not in known and not held <= known:
            found.append(folder)
    return found


def _compacted(spark: SparkSession, path: str, origin: str) -> dict:
    """What a compaction of an origin put in place of which batches."""
    pointer = f"{path.rstrip('/')}/origin={origin}/{POINTER}"
    return json.loads(paths.read_text(spark, pointer)) if paths.exists(spark, pointer) else {}


def _replaced(spark: SparkSession, path: str, origin: str, batch: str) -> bool:
    return batch in _compacted(spark, path, origin).get("replaces", [])


def batches(spark: SparkSession, path: str, origin: str) -> list[str]:
    """Folders of the complete batches of an origin, compacted ones in place of theirs."""
    folder = f"{path.rstrip('/')}/origin={origin}"
    if not paths.exists(spark, folder):
        return []
    compacted = _compacted(spark, path, origin)
    gone = set(compacted.get("replaces", []))
    found = []
    for name in sorted(paths.list_names(spark, folder)):
        batch = name.removeprefix("batch=")
        foreign = batch.startswith(COMPACTED) and batch != compacted.get("batch")
        if name == batch or batch in gone or foreign:
            continue
        if _complete(spark, f"{folder}/{name}"):
            found.append(f"{folder}/{name}")
    return found


def compact_origin(
    spark: SparkSession,
    path: str,
    origin: str,
    run_id: str,
    target_bytes: int = TARGET_FILE_BYTES,
    fmt: str = "parquet",
    reduced: Callable[[DataFrame], DataFrame] | None = None,
) -> str | None:
    """Rewrite the complete batches of an origin as one batch of files of about ``target_bytes``.

    Batches that arrive meanwhile stay beside it. The rows are not sorted, so the batches are
    read once and not shuffled by value. One small file switches readers over; the replaced
    batches are deleted after it. Columns that only some batches have are NULL in the others.
    ``reduced`` may leave out rows that no reader will miss, such as those a newer one replaced.
    """
    old = batches(spark, path, origin)
    if not old:
        return None
    table = read_batches(spark, old, fmt=fmt)
    size = int(table._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())
    folder = f"{path.rstrip('/')}/origin={origin}"
    batch = f"{COMPACTED}{run_id}"
    files = max(1, math.ceil(size / target_bytes))
    if reduced is not None:
        table = reduced(table)
    table.repartition(files).write.mode("overwrite").format(fmt).save(f"{folder}/batch={batch}")
    names = [name.rpartition("/batch=")[2] for name in old]
    replaces = sorted({*_compacted(spark, path, origin).get("replaces", []), *names})
    content = json.dumps({"batch": batch, "replaces": replaces})
    paths.replace_text(spark, f"{folder}/{POINTER}", content)
    for name in old:
        paths.delete(spark, name)
    return f"{folder}/batch={batch}"


def read_origins(
    spark: SparkSession,
    path: str,
    origins: Sequence[str],
    schema: StructType | None = None,
    fmt: str = "parquet",
) -> DataFrame | None:
    """All batches of the given origins as one table; columns an origin lacks are NULL.

    Only complete batches are read. Without a ``schema`` the schemas of the batches are widened
    to one (see `drift`), which opens one footer per batch; name the schema where it is known.
    """
    return read_batches(spark, [f for origin in origins for f in batches(spark, path, origin)], schema, fmt)


def read_batches(
    spark: SparkSession,
    folders: Sequence[str],
    schema: StructType | None = None,
    fmt: str = "parquet",
) -> DataFrame | None:
    """Batches as one table; the columns a batch lacks are NULL."""
    if not folders:
        return None
    if schema is not None:
        return spark.read.format(fmt).schema(schema).load(list(folders))
    return scan_grouped(spark, batch_schemas(spark, folders, fmt), fmt)


def compact(
    spark: SparkSession,
    path: str,
    run_id: str,
    cluster_cols: Sequence[str],
    target_bytes: int = TARGET_FILE_BYTES,
    fmt: str = "parquet",
    sorted_rows: int = SORTED_ROWS,
) -> str:
    """Rewrite the published version as clustered files of about ``target_bytes``.

    Files are smaller where that many bytes are more than about ``sorted_rows`` rows.

    With several ``cluster_cols``, files are stretches of a space-filling curve over them (see
    `curve_key`), so a filter on any of them skips files; with one they are its ranges. The row id
    behind the clustering lets a value that fills many files be split; without it all rows of that
    value would go to one task. The bounds of the ranges are sampled, so the table is read twice,
    and a curve reads its columns once more. Fails with `PublishConflict` if a version is published
    meanwhile.
    """
    path = path.rstrip("/")
    if paths.exists(spark, path) and any(n.startswith("origin=") for n in paths.list_names(spark, path)):
        raise ValueError(f"{path} is append-only: use compact_origin for each origin")
    base = published(spark, path)
    table = load_published(spark, path, fmt)
    by = partition_columns(spark, path)
    # The scan already listed the files, so the optimizer knows their total size.
    size = int(table._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())
    files = max(1, math.ceil(size / target_bytes), math.ceil(table.count() / sorted_rows))
    spread = table.withColumn("_row", F.monotonically_increasing_id())
    order = list(cluster_cols)
    if len(order) > 1:
        spread, order = spread.withColumn("_curve", curve_key(table, cluster_cols)), ["_curve"]
    clustered = (
        spread.repartitionByRange(files, *by, *order, "_row")
        .sortWithinPartitions(*by, *order)
        .drop("_row", "_curve")
    )
    # the rows are the same, so who follows the table has nothing to do
    notes = notes_of(spark, path)
    notes = notes | {"touched": [], "follows": base} if notes else None
    target = version_path(path, run_id)
    if by:
        _write_partitions(clustered, target, fmt, by)
    else:
        overwrite(clustered, path, run_id, fmt, publish_now=False)
    publish(spark, path, run_id, base, notes=notes)
    return target
