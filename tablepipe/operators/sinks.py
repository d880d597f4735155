"""Sinks (K1-K11, K14-K16): idempotent appends, reloads, snapshots, exports.

Keys are applied here because Spark files enforce none:

* a unique key whose value holds a null never conflicts (rows always insert,
  as in a SQL unique constraint) - ``dropDuplicates`` would merge them, so it
  is not used;
* "first row of the batch wins" needs an explicit order; a table has no row
  order, so ``order_by`` is required (use :func:`with_file_order` for files).
"""

from __future__ import annotations

from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tablepipe._util import as_list, order_columns, quote_ident, quote_sql_string, require_columns


def _all_keys_present(keys) -> Column:
    cond = F.lit(True)
    for k in keys:
        cond = cond & F.col(k).isNotNull()
    return cond


def with_file_order(df: DataFrame, col: str = "__ord") -> DataFrame:
    """Add the arrival order of a file source as one orderable column:
    (file path, split start, position within the split). Spark packs splits of
    several files into one task by size, so an id alone does not follow file
    order; within one split ``monotonically_increasing_id`` does. Apply it
    directly on the file scan."""
    order = F.struct(F.col("_metadata.file_path").alias("file"),
                     F.col("_metadata.file_block_start").alias("start"),
                     F.monotonically_increasing_id().alias("pos"))
    return df.select("*", order.alias(col))


# Rows that a task sorts where the number of rows is known.
ROWS_A_TASK = 250_000


def dealt(df: DataFrame, keys, rows: int | None, ranges: bool = False) -> DataFrame:
    """``df`` shuffled by key, unsorted, into partitions of about ``ROWS_A_TASK`` rows; as it is when
    ``rows`` is None. A choice of first rows behind it sorts such partitions instead of whole input
    splits, whose rows can be many times their size in the file. Not for keys that hold a large share
    of the rows: those are not cut before the shuffle.

    ``ranges`` deals by ranges of the keys, cut by a sample, instead of by their hash: for rows that
    are written by days of the first key, so that a task writes the files of its few days and not a
    file of every day (tasks x days files, a few rows each). It reads ``df`` once more."""
    if rows is None:
        return df
    n = max(-(-rows // ROWS_A_TASK), df.sparkSession.sparkContext.defaultParallelism)
    return (df.repartitionByRange if ranges else df.repartition)(n, *[F.col(f"`{k}`") for k in keys])


def dedup_first(df: DataFrame, keys, order_by, rows: int | None = None, ranges: bool = False) -> DataFrame:
    """First row per key by ``order_by``; rows with a null in a key all pass.

    ``row_number() == 1`` lets Spark insert a partial group limit before the
    shuffle, so a hot key is cut to one row per map task before it moves. With the
    number of ``rows`` (keys that seldom repeat) the rows are dealt first (:func:`dealt`)."""
    keys = as_list(keys)
    require_columns(df, keys)
    order = order_columns(order_by)
    if not order:
        raise ValueError("order_by is required to decide which duplicate comes first")
    present = _all_keys_present(keys)
    w = Window.partitionBy(*keys).orderBy(*order)
    first = (dealt(df.where(present), keys, rows, ranges).withColumn("__rn", F.row_number().over(w))
             .where(F.col("__rn") == 1).drop("__rn"))
    return first.unionByName(df.where(~present))


def rows_to_append(batch: DataFrame, target: DataFrame, keys, order_by, batch_unique: bool = False,
                   rows: int | None = None) -> DataFrame:
    """Rows an ``INSERT ... ON CONFLICT DO NOTHING`` of ``batch`` adds to ``target``.

    Existing rows win; within the batch the first row by ``order_by`` wins;
    rows with a null key always insert. The batch is shuffled once by key
    (dedup), the anti join reuses that partitioning, and only the key columns
    of the target are read. ``batch_unique`` says that the batch has one row per
    key and no null key (an aggregate by the key): it is read once, without the
    choice of a first row. ``rows``: the batch's number of rows, see :func:`dealt`."""
    keys = as_list(keys)
    require_columns(batch, keys)
    require_columns(target, keys, "target column")
    if batch_unique:
        return batch.join(target.select(*keys).where(_all_keys_present(keys)), on=keys, how="left_anti")
    order = order_columns(order_by)
    if not order:
        raise ValueError("order_by is required to decide which duplicate comes first")
    present = _all_keys_present(keys)
    w = Window.partitionBy(*keys).orderBy(*order)
    first = (dealt(batch.where(present), keys, rows).withColumn("__rn", F.row_number().over(w))
             .where(F.col("__rn") == 1).drop("__rn"))
    existing = target.select(*keys).where(present)
    fresh = first.join(existing, on=keys, how="left_anti")
    return fresh.unionByName(batch.where(~present))


# A batch's partition values are listed up to this many, beyond that their range cuts the target.
LISTED_VALUES = 1000
# Hash bits of a key filter: buckets of 32,768 bits (the built-in bitmap's size), 16 bits a key,
# at most 16 MB in all; a fuller filter lets more target rows through and changes no result.
_BITMAP_BITS, _BITS_PER_KEY, _MOST_BITMAPS = 32_768, 16, 4096


def key_filter(target: DataFrame, batch: DataFrame, keys, batch_rows: int) -> DataFrame:
    """The rows of ``target`` whose key may be in ``batch``: a Bloom filter of the batch's keys
    (two hashes, built map-side as bitmaps by bucket) goes to every task that scans the target,
    so a key that is surely not in the batch never reaches the shuffle of the join."""
    buckets = min(_MOST_BITMAPS, max(1, -(-batch_rows * _BITS_PER_KEY // _BITMAP_BITS)))
    present = _all_keys_present(keys)
    own = [c for c in target.columns]
    out = target.where(present)
    for seed in (0, 1):
        h = F.xxhash64(*[F.col(f"`{k}`") for k in keys], F.lit(seed))
        bucket, bit = F.pmod(h, F.lit(buckets)), F.pmod(F.shiftright(h, 24), F.lit(_BITMAP_BITS))
        maps = (batch.where(present).select(bucket.alias("__b"), bit.alias("__bit")).groupBy("__b")
                .agg(F.bitmap_construct_agg("__bit").alias("__map")))
        probe = out.withColumns({"__b": bucket, "__bit": bit})
        probe = probe.join(F.broadcast(maps), "__b")
        byte = F.conv(F.hex(F.expr("substring(__map, cast(__bit div 8 as int) + 1, 1)")), 16, 10).cast("int")
        out = probe.where(F.getbit(byte, (F.col("__bit") % 8).cast("int")) == 1).select(*own)
    return out


def pruned_target(target: DataFrame, batch: DataFrame, keys, partition_col: str | None = None,
                  bloom: bool = False) -> DataFrame:
    """The part of ``target`` that can conflict with ``batch``: the partitions the batch has, the
    range of each numeric or time key (literals, so they reach partition pruning and the row-group
    statistics), and with ``bloom`` a filter of its keys. One aggregation of the batch's key columns."""
    from pyspark.sql import types as T

    keys = as_list(keys)
    spans = [k for k in keys if isinstance(batch.schema[k].dataType, (T.NumericType, T.DateType, T.TimestampType, T.TimestampNTZType))]
    known = batch.where(_all_keys_present(keys))
    aggs = [f(F.col(f"`{k}`")).alias(f"{n}{i}") for i, k in enumerate(spans) for n, f in (("lo", F.min), ("hi", F.max))]
    if partition_col is not None:
        p = F.col(f"`{partition_col}`")
        aggs += [F.min(p).alias("plo"), F.max(p).alias("phi"), F.approx_count_distinct(p).alias("pn"), F.count_if(p.isNull()).alias("pnull")]
    stats = known.agg(F.count(F.lit(1)).alias("n"), *aggs).first()
    if not stats["n"]:
        return target.where(F.lit(False))
    if partition_col is not None and not stats["pnull"]:
        p = F.col(f"`{partition_col}`")
        target = target.where(p.between(F.lit(stats["plo"]), F.lit(stats["phi"])))
        if stats["pn"] <= LISTED_VALUES // 2:
            values = [r[0] for r in known.select(p).distinct().limit(LISTED_VALUES + 1).collect()]
            if len(values) <= LISTED_VALUES:
                target = target.where(p.isin(values))
    for i, k in enumerate(spans):
        if k != partition_col:
            target = target.where(F.col(f"`{k}`").between(F.lit(stats[f"lo{i}"]), F.lit(stats[f"hi{i}"])))
    return key_filter(target, known, keys, stats["n"]) if bloom else target


def plan_append(batch: DataFrame, target: str, keys, order_by, fmt: str = "parquet",
                partition_col: str | None = None, batch_unique: bool = False, bloom: bool = False,
                rows: int | None = None) -> DataFrame:
    """The rows :func:`append_ignore_conflicts` would write (lazy but for the batch's key
    range, nothing written).

    ``partition_col``: the column the target is partitioned by - a key, or a column that
    the keys determine (the day of a key's time). The target is then cut to what can
    conflict (:func:`pruned_target`), so a daily batch reads one day of a years-long table.
    ``bloom`` adds a filter of the batch's keys, for a batch much smaller than that part.
    A path that does not exist yet has nothing to conflict with: the first rows of the batch are
    chosen without a join, and dealt by ranges of the keys when it will be partitioned."""
    if _is_path(target) and not batch_unique and not path_exists(batch.sparkSession, target):
        columns = [c for c in batch.columns if not c.startswith("__")]
        return dedup_first(batch, keys, order_by, rows, ranges=partition_col in columns).select(*columns)
    tgt = _read_target(batch.sparkSession, target, fmt, like=batch)
    columns = tgt.columns
    partition_col = partition_col if partition_col in columns else None  # an older target without the column
    if partition_col is not None or bloom:
        if partition_col is not None:
            require_columns(batch, [partition_col])
        tgt = pruned_target(tgt, batch, keys, partition_col, bloom)
    return rows_to_append(batch, tgt, keys, order_by, batch_unique, rows).select(*columns)


def append_ignore_conflicts(batch: DataFrame, target: str, keys, order_by,
                            fmt: str = "parquet", partition_col: str | None = None,
                            batch_unique: bool = False, bloom: bool = False, rows: int | None = None) -> None:
    """Append the non-conflicting rows of ``batch`` to a table or path.
    Running it twice appends nothing the second time for non-null keys. (To
    inspect the rows first, use :func:`plan_append`; re-evaluating it after
    the write would compare against the updated target.)"""
    add = plan_append(batch, target, keys, order_by, fmt, partition_col, batch_unique, bloom, rows)
    if _is_path(target):
        w = add.write.mode("append").format(fmt)
        if partition_col in add.columns:  # keep the target's layout
            w = w.partitionBy(partition_col)
        w.save(target)
    else:
        add.write.insertInto(target)


def check_unique(df: DataFrame, keys, allow_null: bool = False) -> None:
    """Raise if a non-null key repeats (or, unless ``allow_null``, a key is null).

    One job over the key columns only: a keyed count, partially aggregated
    map-side, then a global max / null total."""
    keys = as_list(keys)
    present = _all_keys_present(keys)
    per_key = df.select(*keys).groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    stats = per_key.agg(F.max(F.when(present, F.col("n"))).alias("max_n"),
                        F.sum(F.when(~present, F.col("n"))).alias("null_rows")).first()
    if (stats["max_n"] or 0) > 1:
        sample = per_key.where(present & (F.col("n") > 1)).limit(5).collect()
        raise ValueError(f"duplicate key {keys}, the first {len(sample)}: {[tuple(r) for r in sample]}")
    if not allow_null and (stats["null_rows"] or 0) > 0:
        raise ValueError(f"null in key {keys}: {stats['null_rows']} rows")


def truncate_and_load(df: DataFrame, target: str, contract=None, keys=None,
                      on_duplicate: str = "raise", order_by=None, fmt: str = "parquet") -> None:
    """Replace the content of ``target`` keeping its schema.

    ``on_duplicate='raise'`` checks the key first (a plain insert fails on a
    repeated primary key) and writes nothing on failure; ``'first'`` keeps the
    first row per key, null keys all kept. The target must not be read by
    ``df`` itself: stage to a new path first in that case."""
    from tablepipe.operators.contract import check_contract

    if contract is not None:
        check_contract(df, contract)
        keys = keys if keys is not None else contract.keys
        helpers = [c for c in as_list(order_by) if isinstance(c, str) and c not in contract.names]
        df = df.select(*contract.names, *helpers)
    if keys:
        if on_duplicate == "raise":
            check_unique(df, keys, allow_null=False)
        elif on_duplicate == "first":
            df = dedup_first(df, keys, order_by)
        else:
            raise ValueError("on_duplicate must be 'raise' or 'first'")
    if contract is not None:
        df = df.select(*contract.names)  # order helpers are not written
    if _is_path(target):
        replace_path(df, target, fmt)
    else:
        truncate_table(df, target)


def _fs(spark: SparkSession, path: str):
    """Hadoop's file system of a path, and the path."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p, jvm.org.apache.hadoop.fs.Path


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether something is at a path; a file system that cannot tell raises."""
    fs, at, _ = _fs(spark, path)
    return fs.exists(at)


def delete_path(spark: SparkSession, path: str) -> None:
    """Delete a file or folder with all it holds; nothing happens when there is none."""
    fs, at, _ = _fs(spark, path)
    fs.delete(at, True)


def files_go(spark: SparkSession):
    """For the length of a block, shuffle files go when the query that wrote them ends, not when the
    driver collects garbage."""
    return setting(spark, "spark.sql.classic.shuffleDependency.fileCleanup.enabled", "true")


def staged(df: DataFrame) -> DataFrame:
    """``df`` written to a fresh path in the shared folder and read back: whatever
    can fail in computing it has failed before a target is touched."""
    from tablepipe.session import scratch_path

    path = scratch_path(df.sparkSession, "staged")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def replace_path(df: DataFrame, target: str, fmt: str = "parquet", partition_by=(), **options) -> None:
    """Replace the data at a path: write beside it, then swap by two renames. A
    load that fails leaves the old data as it was; the old data goes last."""
    import uuid

    spark, tag = df.sparkSession, uuid.uuid4().hex[:12]
    base = target.rstrip("/")
    new, old = f"{base}.__new-{tag}", f"{base}.__old-{tag}"
    fs, at, path_of = _fs(spark, base)
    try:
        writer = df.write.format(fmt).options(**options)
        (writer.partitionBy(*partition_by) if partition_by else writer).save(new)
    except Exception:
        fs.delete(path_of(new), True)
        raise
    if fs.exists(at) and not fs.rename(at, path_of(old)):
        fs.delete(path_of(new), True)
        raise OSError(f"cannot move {base} aside")
    if not fs.rename(path_of(new), at):
        fs.rename(path_of(old), at)
        raise OSError(f"cannot move the new data to {base}")
    fs.delete(path_of(old), True)


def write_snapshot(df: DataFrame, path: str, partition_col: str | None = None,
                   skip_empty: bool = True, fmt: str = "parquet",
                   files_per_partition: int | None = None) -> bool:
    """Snapshot to a path. With ``partition_col`` a re-run replaces only the
    partitions present in ``df`` (dynamic overwrite). Returns False when
    skipped because ``df`` is empty.

    ``files_per_partition=k`` shuffles by (partition value, hash salt in
    0..k-1) before writing: at most k files per partition value instead of
    one per task, and a partition value holding a third of the rows is still
    written by k tasks. The salt is a hash of the row, not ``rand()``, so a
    retried task rebuilds the same shuffle."""
    if skip_empty and df.isEmpty():
        return False
    if partition_col and files_per_partition:
        salt = F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in df.columns]), F.lit(files_per_partition))
        df = df.repartition(F.col(partition_col), salt)
    w = df.write.mode("overwrite").format(fmt)
    if partition_col:  # Spark's committer swaps the partitions once all tasks are done
        w.partitionBy(partition_col).option("partitionOverwriteMode", "dynamic").save(path)
    else:
        replace_path(df, path, fmt)
    return True


@contextmanager
def setting(spark: SparkSession, key: str, value: str):
    """A session setting for the length of a block."""
    before = spark.conf.get(key, None)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, before)


class TableInfo:
    """What the catalog knows of a table: kind, location, provider, partition columns, and
    whether the catalog lists its partitions one by one."""

    def __init__(self, spark: SparkSession, table: str):
        import json

        d = json.loads(spark.sql(f"DESCRIBE TABLE EXTENDED {quote_ident(table)} AS JSON").first()[0])
        self.managed = d.get("type", "").upper() == "MANAGED"
        self.location = d["location"]
        self.provider = d.get("provider", "parquet").lower()
        self.partitions = [c["name"] if isinstance(c, dict) else c for c in d.get("partition_columns", [])]
        self.listed = d.get("partition_provider", "").lower() == "catalog"


def _version_path(location: str) -> str:
    """A fresh folder beside a table's location."""
    import re
    import uuid

    return re.sub(r"\.__v-[0-9a-f]{12}$", "", location.rstrip("/")) + f".__v-{uuid.uuid4().hex[:12]}"


def _default_location(spark: SparkSession, table: str) -> str:
    database, _, name = table.rpartition(".")
    return f"{spark.catalog.getDatabase(database or spark.catalog.currentDatabase()).locationUri.rstrip('/')}/{name.lower()}"


def _create_table(spark: SparkSession, table: str, schema, provider: str, partition_by) -> None:
    """An empty managed table whose partitions are found in its folder, not listed in the catalog,
    so that one change of its location changes all of its content."""
    columns = ", ".join(f"{quote_ident(f.name)} {f.dataType.simpleString()}" for f in schema.fields)
    sql = f"CREATE TABLE {quote_ident(table)} ({columns}) USING {provider}"
    if not partition_by:
        spark.sql(sql)
        return
    with setting(spark, "spark.sql.hive.manageFilesourcePartitions", "false"):
        spark.sql(f"{sql} PARTITIONED BY ({', '.join(quote_ident(c) for c in partition_by)})")


def replace_table(df: DataFrame, table: str, partition_by=(), provider: str = "parquet") -> None:
    """Replace a table's content, or create it.

    The new data is written to a folder of its own first, so a load that fails leaves the
    table as it was. Then the table's location is switched - one change in the catalog, so a
    reader sees all of the old data or all of the new - and the old folder goes last. A
    change of schema, partitioning or format drops and creates the table once the new data
    is complete; between these two a reader finds no table."""
    spark, partition_by = df.sparkSession, as_list(partition_by)
    rest = [c for c in df.columns if c not in partition_by]
    df = df.select(*[F.col(f"`{c}`") for c in [*rest, *partition_by]])  # a table's partition columns come last
    info = TableInfo(spark, table) if spark.catalog.tableExists(table) else None
    same = (info is not None and info.managed and not (info.partitions and info.listed) and info.provider == provider
            and info.partitions == partition_by and _types(spark.table(table).schema) == _types(df.schema))
    new = _version_path(info.location if info else _default_location(spark, table))
    writer = df.write.format(provider)
    try:
        (writer.partitionBy(*partition_by) if partition_by else writer).save(new)
    except Exception:
        fs, at, _ = _fs(spark, new)
        fs.delete(at, True)
        raise
    gone = [info.location] if info and info.managed else []  # an external table's folder is its owner's
    if not same:
        spark.sql(f"DROP TABLE IF EXISTS {quote_ident(table)}")
        _create_table(spark, table, df.schema, provider, partition_by)
        gone.append(TableInfo(spark, table).location)
    spark.sql(f"ALTER TABLE {quote_ident(table)} SET LOCATION {quote_sql_string(new)}")
    spark.catalog.refreshTable(table)
    for path in gone:
        fs, at, _ = _fs(spark, path)
        fs.delete(at, True)


def _types(schema) -> list:
    return [(f.name, f.dataType.simpleString()) for f in schema.fields]


def truncate_table(df: DataFrame, table: str) -> None:
    """Replace all rows of a table - every partition, also those that ``df`` has no row of -
    keeping its schema, partitioning, properties and comment. A load that fails leaves the
    old rows."""
    spark = df.sparkSession
    info, schema = TableInfo(spark, table), spark.table(table).schema
    df = df.select(*[F.col(f"`{f.name}`").cast(f.dataType).alias(f.name) for f in schema.fields])
    if info.managed and not (info.partitions and info.listed):
        replace_table(df, table, info.partitions, info.provider)
        return
    # partitions that the catalog lists, or a folder that is the owner's: staged, then all partitions overwritten
    data = staged(df)
    with setting(spark, "spark.sql.sources.partitionOverwriteMode", "static"):
        data.write.insertInto(table, overwrite=True)


def export_csv(df: DataFrame, path: str) -> None:
    """CSV with a header line in every part file and no index column, replacing
    ``path`` once all parts are written. Parts are written in parallel."""
    replace_path(df, path, "csv", header=True, timestampNTZFormat=CSV_TIME)


# Bytes that the copy of parts into one file moves at a time, and the most rows of a part.
COPY_BUFFER = 4 << 20
PART_ROWS = 250_000

CSV_TIME = "yyyy-MM-dd HH:mm:ss[.SSSSSS]"


def export_single_csv(df: DataFrame, path: str) -> None:
    """One CSV file with one header line, replacing ``path`` when it is complete.

    Tasks write parts without headers beside it, which are put behind the header in the
    order of their names (:func:`single_file`). Use :func:`export_csv` where readers take
    a folder of parts."""
    import csv
    import io

    line = io.StringIO()
    csv.writer(line, lineterminator="\n").writerow(df.columns)
    single_file(df.write.option("header", False).option("timestampNTZFormat", CSV_TIME).format("csv"), df.sparkSession, path,
                head=line.getvalue())


def single_file(writer, spark: SparkSession, path: str, head: str = "", tail: str = "", skip: int = 0) -> None:
    """The parts that ``writer`` writes as one file between ``head`` and ``tail``; the first
    ``skip`` bytes of all parts are left out.

    The parts are written by parallel tasks, in files of ``PART_ROWS`` rows at most. The file
    system joins them by reference where it can (HDFS ``concat``), else they are copied through
    a small buffer: one file is one stream there. A part goes when it is copied, so the disk holds
    the data once and one part more. The file takes its name when it is complete."""
    import re
    import uuid

    tag = uuid.uuid4().hex[:12]
    parts, new = f"{path}.__parts-{tag}", f"{path}.__new-{tag}"
    fs, at, path_of = _fs(spark, path)
    by_reference = fs.getScheme() in ("hdfs", "webhdfs") and not tail and not skip
    try:
        writer.option("maxRecordsPerFile", PART_ROWS).save(parts)
        files = [f for f in fs.listStatus(path_of(parts)) if f.getPath().getName().startswith("part-") and f.getLen() > 0]
        number = lambda name: [int(x) for x in re.match(r"part-(\d+)-.*-c(\d+)", name).groups()]  # noqa: E731 - task, file of the task
        files = sorted((f.getPath() for f in files), key=lambda f: number(f.getName()))
        out = fs.create(path_of(new))
        try:
            out.write(bytearray(head.encode()))
            for i, f in enumerate([] if by_reference else files):
                _copy_part(spark, fs, f, out, 0 if i else skip)
                fs.delete(f, False)
            out.write(bytearray(tail.encode()))
        finally:
            out.close()
        if by_reference and files:
            array = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Path, len(files))
            for i, f in enumerate(files):
                array[i] = f
            fs.concat(path_of(new), array)
        if fs.exists(at):
            fs.delete(at, True)
        if not fs.rename(path_of(new), at):
            raise OSError(f"cannot move the new file to {path}")
    finally:
        fs.delete(path_of(parts), True)
        fs.delete(path_of(new), True)


def _copy_part(spark: SparkSession, fs, path, out, skip: int) -> None:
    source = fs.open(path)
    try:
        if skip:
            source.seek(skip)
        spark.sparkContext._jvm.org.apache.hadoop.io.IOUtils.copyBytes(source, out, COPY_BUFFER, False)
    finally:
        source.close()


def write_table(df: DataFrame, table: str, contract=None, existing: str = "drop",
                comment: str | None = None, partition_by=()) -> None:
    """Load into a catalog table. ``existing``: ``drop`` replaces rows and
    schema (:func:`replace_table`), ``truncate`` replaces all rows and keeps the schema
    (:func:`truncate_table`), ``append`` adds rows, ``fail`` refuses an existing table.
    The comment is set after the load, since a replace may drop it."""
    from tablepipe.operators.catalog import set_table_comment
    from tablepipe.operators.contract import conform

    if contract is not None:
        df = conform(df, contract)
    if existing == "drop":
        replace_table(df, table, partition_by)
    elif existing == "truncate":
        truncate_table(df, table)
    elif existing == "append":
        cols = df.sparkSession.table(table).columns
        df.select(*cols).write.insertInto(table)
    elif existing == "fail":
        if df.sparkSession.catalog.tableExists(table):
            raise ValueError(f"table {table} already exists")
        replace_table(df, table, partition_by)
    else:
        raise ValueError("existing must be one of drop, truncate, append, fail")
    if comment is not None:
        set_table_comment(df.sparkSession, table, comment)


def _is_path(target: str) -> bool:
    return "/" in target or ":" in target


def _read_target(spark: SparkSession, target: str, fmt: str, like: DataFrame | None = None) -> DataFrame:
    """The target table or path; a path that does not exist yet reads as an
    empty table shaped like ``like`` (helper columns ``__*`` left out)."""
    if not _is_path(target):
        return spark.table(target)
    if like is not None and not path_exists(spark, target):
        from pyspark.sql import types as T

        return spark.createDataFrame([], T.StructType([f for f in like.schema.fields if not f.name.startswith("__")]))
    return spark.read.format(fmt).load(target)
