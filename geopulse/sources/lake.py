"""The append-only observation lake: landing by period, tolerant reads, table writes."""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from geopulse.operators.upsert import upsert
from geopulse.sources.versions import VersionedSink, filesystem
from geopulse.workspace import materialise


#: Path keys of the two layouts, from coarse to fine.
PERIOD_KEYS = ("region", "year", "month", "day")


def _exists(spark: SparkSession, path: str) -> bool:
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).exists(hadoop)


def layout_paths(root: str, source: str) -> tuple[str, str]:
    """Live and archive folders of a source."""
    return f"{root}/{source}", f"{root}/backfill/{source}"


def reject_path(root: str, source: str) -> str:
    """Where rows without an observation time are kept."""
    return f"{root}/rejected/{source}"


def read_lake(
    spark: SparkSession, root: str, source: str, *, since: str | None = None, until: str | None = None,
    months: Sequence[str] | None = None, regions: Sequence[str] | None = None,
) -> DataFrame | None:
    """Rows of a source under whichever layouts exist, columns united by name; all of them unless something is asked for.

    ``since`` and ``until`` (days), ``months`` (yyyy-MM) and ``regions`` choose folders, so other files are not
    listed as tasks: the live layout by day, the archive, whose folders are months, by month. Each layout is read
    with its own path keys, which do not become columns. An absent source gives ``None``, so that only what is built
    from it is skipped.
    """
    parts = []
    for path in layout_paths(root, source):
        if not _exists(spark, path):
            continue
        rows = spark.read.option("mergeSchema", "true").option("basePath", path).parquet(path)
        keys = [key for key in PERIOD_KEYS if key in rows.columns]
        if "year" in keys and "month" in keys:
            month = F.col("year").cast("int") * 100 + F.col("month").cast("int")
            day = month * 100 + F.col("day").cast("int") if "day" in keys else None
            for bound, low in ((since, True), (until, False)):
                if bound:
                    y, m, d = map(int, str(bound).split("-"))
                    left, right = (month, y * 100 + m) if day is None else (day, (y * 100 + m) * 100 + d)
                    rows = rows.where(left >= right if low else left <= right)
            if months is not None:
                rows = rows.where(month.isin([int(m.replace("-", "")) for m in months]))
        if regions is not None and "region" in keys:
            rows = rows.where(F.col("region").cast("string").isin(list(regions)))
        parts.append(rows.drop(*keys))
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts) if parts else None


def refresh(
    spark: SparkSession, root: str, source: str, path: str, stage: Callable[[DataFrame], DataFrame], day: str,
    months: Sequence[str] | None = None, *, max_records_per_file: int = 5_000_000,
) -> DataFrame:
    """Rebuild the given months of a staged table from the lake, all of them by default; the others stay as they are.

    ``stage`` must work month by month, as latest-wins does whose key holds the time; ``day`` names its day column. A month is
    written by as many tasks as its rows fill files, and one of the given months without rows any more is removed.
    """
    raw = read_lake(spark, root, source, months=months)
    if raw is None:
        raise ValueError(f"the lake holds no {source}")
    staged = materialise(stage(raw).withColumn("_month", F.date_format(day, "yyyy-MM")), "staged")
    line = F.xxhash64(*[F.col(f"`{name}`") for name in staged.columns])
    found = staged.groupBy("_month").agg(F.ceil(F.count(F.lit(1)) / F.lit(max_records_per_file)).alias("_writers"))
    spread = staged.join(F.broadcast(found), "_month").withColumn("_salt", F.pmod(line, F.col("_writers")))  # a row a month
    writer = spread.repartition("_month", "_salt").select(*staged.columns).write.mode("overwrite")
    writer = writer.option("partitionOverwriteMode", "dynamic").option("maxRecordsPerFile", max_records_per_file)
    writer.option("compression", "zstd").partitionBy("_month").parquet(path)
    full = {r["_month"] for r in found.select("_month").collect()}
    fs, jpath = filesystem(spark, path)
    held = {s.getPath().getName().split("=", 1)[1] for s in fs.listStatus(jpath(path)) if s.getPath().getName().startswith("_month=")}
    for month in sorted((held if months is None else held & set(months)) - full):
        fs.delete(jpath(f"{path}/_month={month}"), True)
    return spark.read.parquet(path).drop("_month")


# -- what changed in the lake ---------------------------------------------------


def period_manifest(spark: SparkSession, root: str, source: str) -> DataFrame:
    """``period, files, bytes, mark``: the files of every month of a source, live and archive, as one digest.

    The listing is Spark's own, in parallel over folders; no file is opened. Marks add up, so a month's digest needs no order.
    """
    parts = []
    for kind, folder in zip(("live", "archive"), layout_paths(root, source)):
        fs, path = filesystem(spark, folder)
        if fs.exists(path(folder)):
            listed = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(folder)
            parts.append(listed.select(F.lit(kind).alias("kind"), "path", "length", "modificationTime"))
    if not parts:
        raise ValueError(f"the lake holds no {source}")
    files = reduce(DataFrame.unionByName, parts)
    period = F.concat_ws("-", *(F.regexp_extract("path", f"/{key}=([0-9]+)/", 1) for key in ("year", "month")))
    mark = F.xxhash64("kind", F.regexp_extract("path", "/(region=.*)$", 1), "length", F.unix_micros("modificationTime"))
    files = files.where(F.col("path").rlike("/year=[0-9]+/month=[0-9]+/")).select(period.alias("period"), "length", mark.alias("mark"))
    return files.groupBy("period").agg(
        F.count(F.lit(1)).alias("files"), F.sum("length").alias("bytes"),
        F.hex(F.xxhash64(F.bit_xor("mark"), F.sum(F.shiftright("mark", 20)))).alias("mark"),
    )


def lake_revision(manifest: DataFrame) -> DataFrame:
    """One digest over all periods, as one row; equal as long as no period changed."""
    own = F.xxhash64("period", "files", "bytes", "mark")
    return manifest.agg(F.substring(F.sha2(F.concat_ws("|", F.count(F.lit(1)), F.bit_xor(own), F.sum(F.shiftright(own, 20))), 256), 1, 12).alias("revision"))


def changed_periods(before: DataFrame, after: DataFrame) -> DataFrame:
    """``period, change``: months whose files are new, other or gone since a manifest was taken."""
    old, new = (df.select("period", F.struct("files", "bytes", "mark").alias(name)) for df, name in ((before, "old"), (after, "new")))
    joined = old.join(new, "period", "full").where(~F.col("old").eqNullSafe(F.col("new")))
    change = F.when(F.col("old").isNull(), "new").when(F.col("new").isNull(), "gone").otherwise("other")
    return joined.select("period", change.alias("change"))


def refresh_changed(
    spark: SparkSession, root: str, source: str, path: str, stage: Callable[[DataFrame], DataFrame], day: str, manifests: VersionedSink,
) -> tuple[DataFrame, list[str]]:
    """Rebuild only the months whose files changed since the last time, and remember their state; the staged table and those months.

    The manifest is written after the table, so work that broke off is done again.
    """
    now = materialise(period_manifest(spark, root, source), "manifest")
    known, number = manifests.latest(), (manifests.versions() or [-1])[-1] + 1
    months = None if known is None else sorted(r["period"] for r in changed_periods(known, now).select("period").collect())  # months
    fresh = months is None or bool(months)
    staged = refresh(spark, root, source, path, stage, day, months) if fresh else spark.read.parquet(path).drop("_month")
    if fresh:
        manifests.fold(now, number, lambda _, batch: batch)
    return staged, months if months is not None else sorted(r["period"] for r in now.select("period").collect())


def _period_columns(df: DataFrame, time_col: str, backfill: bool) -> tuple[DataFrame, list[str]]:
    stamp = F.col(time_col)
    keyed = df.withColumns(
        {
            "region": F.coalesce(F.col("region_id"), F.lit("unassigned")),
            "year": F.date_format(stamp, "yyyy"),
            "month": F.date_format(stamp, "MM"),
        }
    )
    keys = ["region", "year", "month"]
    if not backfill:
        keyed, keys = keyed.withColumn("day", F.date_format(stamp, "dd")), [*keys, "day"]
    return keyed, keys


def land(
    df: DataFrame, root: str, source: str, time_col: str, *, backfill: bool = False,
    max_records_per_file: int = 5_000_000,
) -> str:
    """Write rows under their observation day (live) or month (archive), replacing those periods only.

    Running it twice leaves the same lake. A period is spread by a hash over as many writers as its rows fill
    files, so one that holds most of the rows is not written by one task. Rows without an observation time go
    to the source's reject folder, named by their content. An empty frame is refused.
    """
    if df.where(F.col(time_col).isNotNull()).isEmpty():
        raise ValueError(f"refusing to land an empty {source} frame")
    live, archive = layout_paths(root, source)
    path = archive if backfill else live
    line = F.xxhash64(*[F.col(f"`{name}`") for name in df.columns])
    undated = df.where(F.col(time_col).isNull())
    rows, mark = undated.agg(F.count(F.lit(1)), F.bit_xor(line)).first()
    if rows:
        undated.write.mode("overwrite").option("compression", "zstd").parquet(f"{reject_path(root, source)}/batch={rows}-{mark & (1 << 64) - 1:x}")
    keyed, keys = _period_columns(df.where(F.col(time_col).isNotNull()), time_col, backfill)
    writers = keyed.groupBy(*keys).agg(F.ceil(F.count(F.lit(1)) / F.lit(max_records_per_file)).alias("_writers"))
    (
        keyed.join(writers, keys)
        .withColumn("_salt", F.pmod(line, F.col("_writers")))
        .repartition(*keys, "_salt")
        .select(*df.columns, *[key for key in keys if key not in df.columns])
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .option("compression", "zstd")
        .option("maxRecordsPerFile", max_records_per_file)
        .partitionBy(*keys)
        .parquet(path)
    )
    return path


def merge_period(existing: DataFrame, incoming: DataFrame, keys: list[str]) -> DataFrame:
    """Re-landing a period: incoming rows replace those with the same key, the others stay."""
    return upsert(existing, incoming, keys, repeats=True)


def write_table(df: DataFrame, path: str, mode: str = "overwrite") -> DataFrame:
    """Materialise a table and read it back."""
    df.write.mode(mode).option("compression", "zstd").parquet(path)
    return df.sparkSession.read.parquet(path)


def dataset_revision(df: DataFrame) -> DataFrame:
    """Hash over the input files behind a frame (name, size, modification time), as one row.

    The files are listed through the file system; no row is read.
    """
    spark, lines = df.sparkSession, []
    for name in sorted(df.inputFiles()):
        path = spark._jvm.org.apache.hadoop.fs.Path(name)
        status = path.getFileSystem(spark._jsc.hadoopConfiguration()).getFileStatus(path)
        lines.append(f"{path.getName()}|{status.getLen()}|{status.getModificationTime()}")
    return spark.createDataFrame([(hashlib.sha256("\n".join(sorted(lines)).encode()).hexdigest()[:12],)], "revision string")
