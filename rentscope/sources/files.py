"""File datasets: CSV with explicit schema and pandas-style null tokens,
timestamped snapshots, the newest-snapshot scan, zone publishing."""

from __future__ import annotations

import csv
import uuid
from collections.abc import Callable, Iterator, Mapping
from functools import reduce
from urllib.parse import quote, unquote

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rentscope.functions.formatting import snapshot_stamp
from rentscope.operators.keys import dense_ids
from rentscope.session import scratch_path
from rentscope.sources.commits import _hadoop, commit, read_state
from rentscope.sources.ranges import Ranges

# The strings pandas.read_csv reads as missing by default.
PANDAS_NA_TOKENS = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
    "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a",
    "nan", "null",
]
SNAPSHOT_COL = "snapshot_ts"
CSV_OPTIONS = {"header": "true", "escape": '"', "multiLine": "true",
               # keep cell text as is (Spark trims on write by default; pandas does not)
               "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}


def _null_tokens(c: Column, tokens) -> Column:
    return F.when(~c.isin(list(tokens)), c)


_INTEGRAL = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)


def _typed(c: Column, dtype: T.DataType) -> Column:
    """Text -> ``dtype``; a value that does not parse becomes null.  Integral
    columns also accept a whole number written as a float (``1500.0``,
    what pandas writes for an integer column holding a missing value)."""
    if isinstance(dtype, T.StringType):
        return c
    if isinstance(dtype, _INTEGRAL):
        num = c.try_cast("decimal(38,6)")
        return F.coalesce(c.try_cast(dtype), F.when(num == F.floor(num), num.try_cast(dtype)))
    return c.try_cast(dtype)


def exists(spark: SparkSession, path: str) -> bool:
    """Whether the path is there; other errors (permissions, network) are raised."""
    p, fs = _hadoop(spark, path)
    return fs.exists(p)


def child_names(spark: SparkSession, folder: str) -> list[str]:
    """Names of the first level of a folder (one per snapshot; no file below
    is listed); empty when there is no folder."""
    p, fs = _hadoop(spark, folder)
    return [s.getPath().getName() for s in fs.listStatus(p)] if fs.exists(p) else []


def listing(spark: SparkSession, folder: str) -> tuple:
    """Name, length and time of change of what is in a folder (one level)."""
    p, fs = _hadoop(spark, folder)
    return tuple(sorted((s.getPath().getName(), s.getLen(), s.getModificationTime()) for s in fs.listStatus(p)))


def delete(spark: SparkSession, path: str) -> None:
    p, fs = _hadoop(spark, path)
    fs.delete(p, True)


def size_bytes(spark: SparkSession, path: str) -> int:
    p, fs = _hadoop(spark, path)
    return fs.getContentSummary(p).getLength()


HEAD_BYTES = 1 << 14


def first_record(text: str, whole: bool) -> str | None:
    """The first CSV record of ``text``, which may hold line breaks inside
    quotes; None if it may go on after the text's end (unless that is ``whole``)."""
    at = quotes = 0
    while True:
        end = text.find("\n", at)
        if end < 0:
            return text if whole else None
        quotes += text.count('"', at, end)
        if quotes % 2 == 0:
            return text[:end].removesuffix("\r")
        at = end + 1


def _head(path: str) -> str:
    """A file's first record, by reading its head alone."""
    with Ranges(path, encoded=True) as read:
        size = HEAD_BYTES
        while True:
            whole = size >= read.size
            record = first_record(read(0, size).decode("utf-8", "ignore"), whole)
            if record is not None:
                return record
            size *= 4


def _headers(spark: SparkSession, path: str, names: list[str]) -> DataFrame:
    """(file, columns, at, length) of every file: the number of its columns, and
    where each of ``names`` stands in its header (-1: nowhere).  Tasks read the
    heads of the files; where they cannot open them, Spark reads the lines."""
    def placed(head: str | None) -> tuple[int, list[int]]:
        own = next(csv.reader([(head or "").lstrip("\ufeff")]), [])
        where = {n: i for i, n in reversed(list(enumerate(own)))}  # of a repeated name the first
        return len(own), [where.get(n, -1) for n in names]

    def run(batches) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            files = batch.column("file").to_pylist()
            heads = batch.column("head").to_pylist() if "head" in batch.schema.names else map(_head, files)
            sizes, places = zip(*map(placed, heads)) if files else ((), ())
            yield pa.record_batch([batch.column("file"), pa.array(sizes, pa.int32()), pa.array(places, pa.list_(pa.int32())),
                                   batch.column("length")], ["file", "columns", "at", "length"])
    files = spark.read.format("binaryFile").load(path).select(
        F.col("_metadata.file_path").alias("file"), "length")  # a listing: no content is read
    if not Ranges.can(_hadoop(spark, path)[1].getUri().toString()):
        lines = spark.read.text(path).select(
            F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("_block"),
            F.monotonically_increasing_id().alias("_i"), "value").filter("_block = 0")
        files = files.join(lines.groupBy("file").agg(F.min_by("value", "_i").alias("head")), "file", "left")
    return files.mapInArrow(run, "file string, columns int, at array<int>, length long")


def _breaks_in_cells(spark: SparkSession, path: str) -> bool:
    """Whether a line has an odd number of quotes: a cell holds a line break."""
    lines = spark.read.text(path).select(F.length("value") - F.length(F.replace("value", F.lit('"'))))
    return not lines.toDF("quotes").filter("quotes % 2 = 1").isEmpty()


def read_csv(spark: SparkSession, path: str, schema: T.StructType,
             null_tokens=PANDAS_NA_TOKENS, seq_col: str | None = None,
             one_header: bool = False, multi_line: bool | None = None) -> DataFrame:
    """CSV with a header, columns matched **by header name** and cast to
    ``schema`` (never inferred).  Any cell equal to a null token becomes
    null; a value that does not parse as its declared type becomes null
    instead of failing; a schema column missing from a file is null --
    except ``seq_col``, which then numbers the rows 1..n in file order
    (files by name, rows as they stand).

    Files may have different headers, any number of them: tasks read the heads
    of the files and note where each column stands, and one scan of all files
    takes every cell from its file's place.  ``one_header`` skips looking for
    them (files of one writer).  Cells may hold line breaks (``multi_line``),
    which keeps a file in one task; by default that is found out where a file
    is larger than a task's share, and such files are split if no cell does."""
    if one_header:
        options = CSV_OPTIONS | {"multiLine": str(multi_line is not False).lower()}
        return _csv_columns(spark.read.options(**options).csv(path), schema, null_tokens, seq_col)
    staged = scratch_path(spark, "csv-headers")
    _headers(spark, path, schema.names).write.parquet(staged)
    headers = spark.read.parquet(staged)
    found = headers.agg(F.max("columns").alias("columns"), F.max("length").alias("length")).first()
    if not found["columns"]:
        return spark.createDataFrame([], schema)
    if multi_line is None:
        share = spark._jsparkSession.sessionState().conf().filesMaxPartitionBytes()
        multi_line = found["length"] <= share or _breaks_in_cells(spark, path)
    cells = [f"_c{i}" for i in range(found["columns"])]
    rows = (spark.read.schema(", ".join(f"{c} string" for c in cells))
            .options(**CSV_OPTIONS | {"multiLine": str(multi_line).lower()}).csv(path)
            .withColumns({"_file": F.col("_metadata.file_path"), "_block": F.col("_metadata.file_block_start")})
            .withColumn("_i", F.monotonically_increasing_id()))
    rows = (rows.select(F.array(*cells).alias("_cells"), "_file", "_block", "_i")
            .join(headers.select(F.col("file").alias("_file"), F.col("at").alias("_at")), "_file"))
    place = {name: F.col("_at")[k] for k, name in enumerate(schema.names)}
    texts = {name: F.when(at >= 0, F.col("_cells")[F.greatest(at, F.lit(0))]) for name, at in place.items()}
    typed = [_typed(_null_tokens(texts[f.name], null_tokens) if null_tokens else texts[f.name], f.dataType).alias(f.name)
             for f in schema.fields]
    out = rows.select(*typed, "_file", "_block", "_i")
    if seq_col in schema.names and not headers.filter(F.col("at")[schema.names.index(seq_col)] < 0).isEmpty():
        order = out.withColumn("_order", F.struct("_file", "_block", "_i")).drop(seq_col)
        out = dense_ids(order, "_order", seq_col).withColumn(seq_col, F.col(seq_col).cast(schema[seq_col].dataType))
    return out.select(*schema.names)


def _csv_columns(df: DataFrame, schema: T.StructType, null_tokens, seq_col=None, extra=()) -> DataFrame:
    present = set(df.columns)
    cols = []
    for f in schema.fields:
        if f.name in present:
            c = _null_tokens(F.col(f.name), null_tokens) if null_tokens else F.col(f.name)
            cols.append(_typed(c, f.dataType).alias(f.name))
        else:
            cols.append(F.lit(None).cast(f.dataType).alias(f.name))
    return df.select(*cols, *extra)


def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Distributed CSV write with a header (one file per task)."""
    df.write.mode(mode).options(**CSV_OPTIONS).csv(path)


def write_dataset(df: DataFrame, path: str, mode: str = "overwrite", fmt: str = "parquet") -> None:
    df.write.mode(mode).format(fmt).options(**(CSV_OPTIONS if fmt == "csv" else {})).save(path)


def write_snapshot(df: DataFrame, root: str, stamp: str | Column | None = None,
                   fmt: str = "parquet") -> None:
    """Append ``df`` as snapshot(s) under ``root``, partitioned by
    ``snapshot_ts`` (``yyyyMMdd_HHmmss``).  ``stamp`` is a fixed stamp, a
    column (one snapshot per distinct value), or None for the wall clock."""
    if stamp is None:
        stamp_col = snapshot_stamp(F.localtimestamp())
    elif isinstance(stamp, str):
        stamp_col = F.lit(stamp)
    else:
        stamp_col = stamp
    out = df.withColumn(SNAPSHOT_COL, stamp_col)
    (out.write.mode("append").format(fmt).partitionBy(SNAPSHOT_COL)
        .options(**(CSV_OPTIONS if fmt == "csv" else {})).save(root))


def snapshot_schema(schema: T.StructType) -> T.StructType:
    return T.StructType(schema.fields + [T.StructField(SNAPSHOT_COL, T.StringType(), True)])


def read_snapshots(spark: SparkSession, root: str, schema: T.StructType,
                   fmt: str = "parquet", stamp: str | None = None) -> DataFrame:
    """All snapshots, or the one of ``stamp`` (only its folder is listed)."""
    root = root.rstrip("/")
    path = root if stamp is None else f"{root}/{SNAPSHOT_COL}={quote(stamp)}"
    if fmt == "csv" and stamp is not None:
        return read_csv(spark, path, schema).withColumn(SNAPSHOT_COL, F.lit(stamp))
    if fmt == "csv":
        parts = [read_snapshots(spark, root, schema, fmt, s) for s in snapshot_stamps(spark, root)]
        return reduce(DataFrame.unionByName, parts) if parts else spark.createDataFrame([], snapshot_schema(schema))
    return spark.read.schema(snapshot_schema(schema)).format(fmt).option("basePath", root).load(path)


def snapshot_stamps(spark: SparkSession, root: str) -> list[str]:
    """Stamps of the snapshots under ``root``, in order, from the names of its
    first level alone."""
    head = f"{SNAPSHOT_COL}="
    return sorted(unquote(n[len(head):]) for n in child_names(spark, root) if n.startswith(head))


def latest_snapshot_stamp(spark: SparkSession, root: str) -> str | None:
    """The newest stamp (stamps sort as text)."""
    return max(snapshot_stamps(spark, root), default=None)


def read_latest_snapshot(spark: SparkSession, root: str, schema: T.StructType,
                         fmt: str = "parquet") -> DataFrame | None:
    """Rows of the newest snapshot only: its folder is chosen by name and is
    the only one that is listed.  ``None`` when there is no snapshot."""
    latest = latest_snapshot_stamp(spark, root)
    return None if latest is None else read_snapshots(spark, root, schema, fmt, latest)


def _published_runs(spark: SparkSession, target: str) -> tuple[int, dict[str, dict]]:
    version, state = read_state(spark, target)
    return version, state.get("snapshots", {})


def _publish(spark: SparkSession, sources: Mapping[str, str], read: Callable[[str], DataFrame], target: str) -> str:
    """Publish the snapshots (name -> source folder) that the zone does not
    hold, or holds from other files.  Each is written to a folder of its own;
    all become visible with one commit.  What a killed call has written is
    named by no commit, so the next call writes it again."""
    version, held = _published_runs(spark, target)
    changed = {}
    for name, path in sources.items():
        p, fs = _hadoop(spark, path)
        now = fs.getContentSummary(p)
        source = {"files": now.getFileCount(), "bytes": now.getLength()}
        if held.get(name, {}).get("source") != source:
            changed[name] = {"source": source, "folder": f"{SNAPSHOT_COL}={quote(name)}/run-{uuid.uuid4().hex[:12]}"}
    if not changed:
        return target
    paths = {name: f"{target.rstrip('/')}/{entry['folder']}" for name, entry in changed.items()}
    write_concurrently({paths[name]: read(name) for name in changed}, "errorifexists")
    for name, path in paths.items():
        changed[name]["rows"] = spark.read.parquet(path).count()  # from the files' footers
    commit(spark, target, version, {"snapshots": held | changed})
    return target


def read_published(spark: SparkSession, target: str, schema: T.StructType) -> DataFrame:
    """All published snapshots with their ``snapshot_ts``: only what the zone's
    newest commit names."""
    runs = _published_runs(spark, target)[1]
    if not runs:
        return spark.createDataFrame([], snapshot_schema(schema))
    return (spark.read.schema(snapshot_schema(schema)).option("basePath", target)
            .parquet(*(f"{target.rstrip('/')}/{r['folder']}" for _, r in sorted(runs.items()))))


def published(spark: SparkSession, target: str) -> dict[str, int]:
    """Rows of every published snapshot, from the commit alone."""
    return {name: r["rows"] for name, r in sorted(_published_runs(spark, target)[1].items())}


def vacuum(spark: SparkSession, target: str) -> list[str]:
    """Delete the run folders that the newest commit does not name (left by a
    killed call, or replaced); not while another call writes.  Returns them."""
    keep = {r["folder"] for r in _published_runs(spark, target)[1].values()}
    gone = []
    for name in child_names(spark, target):
        for run in child_names(spark, f"{target.rstrip('/')}/{name}") if name.startswith(f"{SNAPSHOT_COL}=") else []:
            if f"{name}/{run}" not in keep:
                delete(spark, f"{target.rstrip('/')}/{name}/{run}")
                gone.append(f"{name}/{run}")
    return gone


def publish_snapshots(spark: SparkSession, root: str, target: str, schema: T.StructType,
                      fmt: str = "parquet") -> str:
    """Every raw snapshot to the zone, each under its own stamp; those that the
    zone holds already are neither read nor written."""
    root = root.rstrip("/")
    return _publish(spark, {s: f"{root}/{SNAPSHOT_COL}={quote(s)}" for s in snapshot_stamps(spark, root)},
                    lambda stamp: read_snapshots(spark, root, schema, fmt, stamp).drop(SNAPSHOT_COL), target)


def write_concurrently(jobs: Mapping[str, DataFrame], mode: str = "overwrite",
                       fmt: str = "parquet", max_parallel: int = 4) -> None:
    """Write independent datasets as concurrent Spark jobs; the scheduler
    interleaves their tasks, so small writes no longer leave cores idle.
    ``InheritableThread`` carries the caller's job group, description and
    scheduler pool into each job (so cancelling the group cancels them).
    Any failure is re-raised."""
    from pyspark import InheritableThread
    items = list(jobs.items())
    if len(items) <= 1:
        for path, df in items:
            write_dataset(df, path, mode, fmt)
        return
    errors: list[BaseException] = []

    def one(path: str, df: DataFrame) -> None:
        try:
            write_dataset(df, path, mode, fmt)
        except BaseException as e:  # noqa: BLE001  (re-raised by the caller)
            errors.append(e)

    for start in range(0, len(items), max_parallel):
        threads = [InheritableThread(target=one, args=item) for item in items[start:start + max_parallel]]
        for t in threads:
            t.start()
        for t in threads:
            t.join()
    if errors:
        raise errors[0]


def publish_zone(tables: Mapping[str, DataFrame], root: str, zone: str,
                 fmt: str = "parquet", mode: str = "overwrite") -> dict[str, str]:
    """Write each table to ``root/zone/name`` (any Hadoop path: local,
    ``hdfs://``, ``s3a://`` ...), concurrently; returns the written paths."""
    return {name: p for (_, name), p in publish_zones({zone: tables}, root, fmt, mode).items()}


def publish_zones(zones: Mapping[str, Mapping[str, DataFrame]], root: str,
                  fmt: str = "parquet", mode: str = "overwrite") -> dict[tuple[str, str], str]:
    """Several zones at once (``{zone: {name: df}}``), all writes concurrent;
    returns ``{(zone, name): path}``."""
    paths = {(z, n): f"{root.rstrip('/')}/{z}/{n}" for z, tables in zones.items() for n in tables}
    write_concurrently({paths[(z, n)]: df for z, tables in zones.items() for n, df in tables.items()},
                       mode, fmt)
    return paths


def write_named_snapshot(df: DataFrame, folder: str, prefix: str = "listings_",
                         stamp: str | None = None, fmt: str = "csv") -> str:
    """Write ``df`` as ``folder/<prefix><yyyyMMdd_HHmmss>.<fmt>`` (a dataset
    directory named like the single files of a flat snapshot folder);
    returns the path."""
    if stamp is None:
        stamp = df.sparkSession.range(1).select(
            snapshot_stamp(F.localtimestamp())).first()[0]
    path = f"{folder.rstrip('/')}/{prefix}{stamp}.{fmt}"
    write_dataset(df, path, "errorifexists", fmt)
    return path


def snapshot_names(spark: SparkSession, folder: str, prefix: str, fmt: str) -> list[str]:
    """Timestamp-named snapshots of a folder, in order (names of one level)."""
    return sorted(n for n in child_names(spark, folder) if n.startswith(prefix) and n.endswith(f".{fmt}"))


def read_named_snapshot(spark: SparkSession, path: str, schema: T.StructType, fmt: str = "csv",
                        null_tokens=PANDAS_NA_TOKENS, seq_col: str | None = "listing_seq") -> DataFrame:
    if fmt == "csv":
        return read_csv(spark, path, schema, null_tokens, seq_col)
    return spark.read.schema(schema).format(fmt).load(path)


def read_latest_named_snapshot(spark: SparkSession, folder: str, schema: T.StructType,
                               prefix: str = "listings_2", fmt: str = "csv",
                               null_tokens=PANDAS_NA_TOKENS,
                               seq_col: str | None = "listing_seq") -> DataFrame | None:
    """Newest snapshot of a folder of timestamp-named snapshots (files or
    dataset directories ``<prefix>...<.fmt>``): the name that sorts last
    wins; no older snapshot is listed or read."""
    names = snapshot_names(spark, folder, prefix, fmt)
    if not names:
        return None
    return read_named_snapshot(spark, f"{folder.rstrip('/')}/{names[-1]}", schema, fmt, null_tokens, seq_col)


def publish_named_snapshots(spark: SparkSession, folder: str, target: str, schema: T.StructType,
                            prefix: str = "listings_2", fmt: str = "csv",
                            seq_col: str | None = "listing_seq") -> str:
    """Every timestamp-named raw snapshot that the zone does not hold yet,
    each under its own name (as ``snapshot_ts``)."""
    folder = folder.rstrip("/")
    return _publish(spark, {n.removesuffix(f".{fmt}"): f"{folder}/{n}" for n in snapshot_names(spark, folder, prefix, fmt)},
                    lambda own: read_named_snapshot(spark, f"{folder}/{own}.{fmt}", schema, fmt, seq_col=seq_col), target)
