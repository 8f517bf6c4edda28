"""Write side: compaction, guarded publishing, atomic replacement of serving tables."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from .observations import boundary_column, dedup_messages, merge_at_cutover

# Fixed policy of the history that must not be overwritten.
PROTECTED_DAYS = frozenset({"2026-08-21", "2026-08-22", "2026-08-23", "2026-08-24", "2026-08-25"})
CUTOVER_DAY = "2026-08-20"
KNOWN_INCOMPLETE = frozenset({"2026-08-16"})


#: Bytes of a file that compaction aims at.
TARGET_BYTES = 128 << 20


class PublishError(RuntimeError):
    """A step refused to write, or what it wrote does not hold."""


def _files(spark: SparkSession, path: str):
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), hadoop


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = _files(spark, path)
    return fs.exists(p)


def delete(spark: SparkSession, path: str) -> None:
    fs, p = _files(spark, path)
    fs.delete(p, True)


def rename(spark: SparkSession, source: str, target: str) -> None:
    fs, p = _files(spark, source)
    if not fs.rename(p, _files(spark, target)[1]):
        raise PublishError(f"{source} can't be renamed to {target}")


def found_folders(spark: SparkSession, *patterns: str) -> list[str]:
    """What there is of some paths with wild cards."""
    out = []
    for pattern in patterns:
        fs, p = _files(spark, pattern)
        out += [s.getPath().toString() for s in fs.globStatus(p) or []]
    return out


@dataclass
class Compacted:
    read: int
    written: int


def sized_files(spark: SparkSession, path: str) -> dict[str, int]:
    """The parquet files in a folder and their bytes."""
    fs, p = _files(spark, path)
    found = [(s.getPath().toString(), s.getLen()) for s in fs.listStatus(p)] if fs.exists(p) else []
    return {f: n for f, n in found if f.endswith(".parquet") and f.rsplit("/", 1)[1][0] not in "._"}


def files_for(total_bytes: int, target_bytes: int = TARGET_BYTES) -> int:
    """How many files of about target_bytes that many bytes make."""
    return max(1, round(total_bytes / target_bytes))


def compact_day(spark: SparkSession, staging: str, silver: str, city: str, date: str, today: str, target_bytes: int = TARGET_BYTES) -> Compacted:
    """Staged messages of a city and day as one silver partition, copies removed, in as many files
    as the staged bytes ask for.

    Refuses a day that is not over. The list of staged files is taken first and written beside
    the day; only these are read and, after the result was read back and verified, deleted, so
    what arrives meanwhile stays. A day that is published is left alone: files of its list that
    a run that broke off left behind are deleted, others are late records and refused."""
    if date >= today:
        raise PublishError(f"{date} is not over")
    part = f"city={city}/dt={date}"
    target, taken = f"{silver}/{part}", f"{silver}/_taken/{part}"
    sizes = sized_files(spark, f"{staging}/{part}")
    staged = list(sizes)
    if exists(spark, target):
        known = {r["file"] for r in spark.read.parquet(taken).collect()} if exists(spark, taken) else set()  # one day's files
        if late := [f for f in staged if f not in known]:
            raise PublishError(f"{target} is published already; {len(late)} files of late records need a decision")
        for f in staged:
            delete(spark, f)
        return Compacted(0, 0)
    if not staged:
        raise PublishError(f"nothing is staged for {part}")
    seen = Observation()
    once = dedup_messages(spark.read.parquet(*staged).observe(seen, F.count(F.lit(1)).alias("read")))
    building = f"{silver}/_building/{part}"
    key = ["kafka_partition", "kafka_offset"]
    once.repartitionByRange(files_for(sum(sizes.values()), target_bytes), *key).sortWithinPartitions(*key).write.mode("overwrite").option("compression", "zstd").parquet(building)
    n = spark.read.parquet(building).groupBy(*key).agg(F.count("*").alias("n")).agg(F.sum("n").alias("n"), F.count("*").alias("keys")).first()
    if not n["n"] or n["n"] != n["keys"]:
        raise PublishError(f"{building}: {n['n']} rows, {n['keys']} keys")
    spark.createDataFrame([(f,) for f in staged], "file string").coalesce(1).write.mode("overwrite").parquet(taken)
    fs, p = _files(spark, target)
    fs.mkdirs(p.getParent())
    rename(spark, building, target)
    for f in staged:
        delete(spark, f)
    return Compacted(seen.get["read"], n["n"])


def packed(sizes: dict[str, int], capacity: int) -> list[list[str]]:
    """Files dealt to bins of about capacity bytes: the largest first, each to the first bin that
    has room for it. A file above the capacity has a bin of its own."""
    bins: list[tuple[int, list[str]]] = []
    for name, size in sorted(sizes.items(), key=lambda f: (-f[1], f[0])):
        at = next((k for k, (held, _) in enumerate(bins) if held + size <= capacity), None)
        if at is None:
            bins.append((size, [name]))
        else:
            bins[at] = (bins[at][0] + size, [*bins[at][1], name])
    return [names for _, names in bins]


def _whole(df: DataFrame) -> tuple:
    """Count and a sum of hashes of all rows, in whatever order."""
    row = F.xxhash64(*[F.col(f"`{c}`") for c in sorted(df.columns)]).cast("decimal(38,0)")
    return tuple(df.agg(F.count("*"), F.sum(row)).first())


def recompact(spark: SparkSession, folder: str, order: Sequence[str] = (), target_bytes: int = TARGET_BYTES) -> tuple[int, int]:
    """Rewrite the files of a folder (a partition) so that they have about target_bytes: small ones
    are put together, bin by bin, rows ordered within each. Nothing is done where no two files
    fit into one. The new folder is written beside the old, compared with it row for row by
    hashes, and takes its place by renaming; a run that broke off in between is finished by the
    next. Returns the numbers of files before and after."""
    parent, name = folder.rstrip("/").rsplit("/", 1)
    building, bins_at, old = (f"{parent}/_{kind}-{name}" for kind in ("building", "bins", "old"))  # names that scans pass over
    if exists(spark, old):  # a run ended between the two renames, or before it cleared up
        if not exists(spark, folder):
            rename(spark, building, folder)
        delete(spark, old)
    sizes = sized_files(spark, folder)
    bins = packed(sizes, target_bytes)
    if len(bins) >= len(sizes):
        return len(sizes), len(sizes)
    # One day's files: a row each.
    number = spark.createDataFrame([(f.rsplit("/", 1)[1], k) for k, names in enumerate(bins) for f in names], "_file string, _bin int")
    rows = spark.read.parquet(*sizes)
    columns = rows.columns
    dealt = rows.withColumn("_file", F.col("_metadata.file_name")).join(F.broadcast(number), "_file").drop("_file")
    for left in (building, bins_at):
        delete(spark, left)
    dealt.repartition(len(bins), "_bin").sortWithinPartitions("_bin", *order).write.option("compression", "zstd").partitionBy("_bin").parquet(bins_at)
    fs, p = _files(spark, building)
    fs.mkdirs(p)
    for k in range(len(bins)):
        for f in sized_files(spark, f"{bins_at}/_bin={k}"):
            rename(spark, f, f"{building}/bin-{k:05d}-{f.rsplit('/', 1)[1]}")
    delete(spark, bins_at)
    back = spark.read.parquet(building)
    if back.columns != columns or _whole(back) != _whole(rows):
        raise PublishError(f"{building}: what was written differs from what was read")
    rename(spark, folder, old)
    rename(spark, building, folder)
    delete(spark, old)
    return len(sizes), len(sized_files(spark, folder))


def late_records(spark: SparkSession, staging: str, silver: str, city: str, date: str) -> DataFrame | None:
    """What is staged for a day that is published already and was not part of it; None if
    there is nothing."""
    part = f"city={city}/dt={date}"
    if not exists(spark, f"{silver}/_taken/{part}"):
        return None
    known = {r["file"] for r in spark.read.parquet(f"{silver}/_taken/{part}").collect()}  # one day's files
    late = [f for f in sized_files(spark, f"{staging}/{part}") if f not in known]
    return spark.read.parquet(*late) if late else None


def current_version(spark: SparkSession, path: str) -> str | None:
    """The version that a published table's pointer names; None before the first."""
    fs, p = _files(spark, f"{path}/_current")
    if not fs.exists(p):
        return None
    stream = fs.open(p)
    try:
        return bytes(stream.readAllBytes()).decode()
    finally:
        stream.close()


def _point(spark: SparkSession, path: str, version: str) -> None:
    """Let the pointer name a version: written beside it and renamed over it, in one step."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    fs, new = _files(spark, f"{path}/_current.new")
    stream = fs.create(new, True)
    stream.write(bytearray(version.encode()))
    stream.close()
    overwrite = jvm.org.apache.hadoop.fs.Options.Rename.OVERWRITE
    options = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 1)
    options[0] = overwrite
    qualified = fs.makeQualified(new)
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(qualified.toUri(), conf)
    context.rename(qualified, fs.makeQualified(_files(spark, f"{path}/_current")[1]), options)


def read_published(spark: SparkSession, path: str) -> DataFrame:
    """The version of a published table that its pointer names."""
    version = current_version(spark, path)
    if version is None:
        raise PublishError(f"nothing is published at {path}")
    return spark.read.parquet(f"{path}/{version}")


def violations(df: DataFrame, keys: Sequence[str] = (), required: Sequence[str] = (), allowed: dict[str, Sequence[str]] | None = None) -> DataFrame:
    """What a table's declaration forbids: one row (rule, n) for each rule that rows break:
    null in a key or a required column, a value that is not allowed, a key that is not unique."""
    rules = {f"{c} is null": F.col(c).isNull() for c in dict.fromkeys([*keys, *required])}
    rules |= {f"{c} has another value": F.col(c).isNotNull() & ~F.col(c).isin(*values) for c, values in (allowed or {}).items()}
    found = []
    if rules:
        counts = df.agg(*[F.count_if(rule).alias(f"r{k}") for k, rule in enumerate(rules.values())])
        found.append(counts.select(F.explode(F.array(*[F.struct(F.lit(name).alias("rule"), F.col(f"r{k}").alias("n")) for k, name in enumerate(rules)])).alias("x")).select("x.*"))
    if keys:
        several = df.groupBy(*keys).agg(F.count("*").alias("n")).where("n > 1")
        found.append(several.agg(F.lit(f"{', '.join(keys)} not unique").alias("rule"), F.count("*").alias("n")))
    out = found[0]
    for more in found[1:]:
        out = out.union(more)
    return out.where("n > 0")


def swap(spark: SparkSession, df: DataFrame, path: str, keys: Sequence[str] = (), keep: int = 1) -> int:
    """Publish df at path: written as a version of its own, checked (rows, keys), then named by
    the pointer in one step, so that readers (read_published) see the old table or the new
    one. An empty df or a failed check leaves the old one. keep old versions stay for those
    who still read them."""
    before, version = current_version(spark, path), f"v-{dt.datetime.now(dt.UTC):%Y%m%dT%H%M%S%f}"
    df.write.parquet(f"{path}/{version}")
    rows = spark.read.parquet(f"{path}/{version}")
    n = rows.count()
    broken = [r["rule"] for r in violations(rows, keys).collect()] if keys and n else []  # a row for each rule
    if not n or broken:
        delete(spark, f"{path}/{version}")
        raise PublishError(f"nothing to publish at {path}" if not n else f"{path}: {'; '.join(broken)}")
    _point(spark, path, version)
    fs, p = _files(spark, path)
    old = sorted(x for s in fs.listStatus(p) if (x := s.getPath().getName()).startswith("v-") and x not in (version, before))
    for name in old[: len(old) - max(0, keep - 1)]:
        delete(spark, f"{path}/{name}")
    return n


def is_protected(date: str, force: bool = False) -> bool:
    """Whether a backfill must leave a day alone."""
    return date in PROTECTED_DAYS and not force


@dataclass
class Backfilled:
    rows: int
    incomplete: bool


def backfill_positions(spark: SparkSession, rows: DataFrame, silver: str, city: str, date: str, force: bool = False) -> Backfilled | None:
    """Historical positions of a city and day as a silver partition. A protected day is never
    overwritten, an existing one only with force, except the day of the cutover, where what is
    there is merged: history before the first live row, live rows from there on. What was
    written is read back and compared in rows and columns. Says whether the day is known to
    be incomplete; None if it was left alone."""
    target = f"{silver}/city={city}/dt={date}"
    there = exists(spark, target)
    if date in PROTECTED_DAYS or (there and date != CUTOVER_DAY and not force):
        return None
    if there and date == CUTOVER_DAY:
        live = spark.read.parquet(target)
        rows = merge_at_cutover(rows, live, boundary_column(rows, live))
    building = f"{silver}/_building/city={city}/dt={date}"
    seen = Observation()
    rows.observe(seen, F.count(F.lit(1)).alias("n")).write.mode("overwrite").option("compression", "zstd").parquet(building)
    back = spark.read.parquet(building)
    if back.count() != seen.get["n"] or back.columns != rows.columns:
        raise PublishError(f"{building}: what was written differs from what was read")
    fs, p = _files(spark, target)
    fs.mkdirs(p.getParent())
    delete(spark, target)
    rename(spark, building, target)
    return Backfilled(seen.get["n"], date in KNOWN_INCOMPLETE)


def dates_between(first: str, last: str) -> list[str]:
    a, b = dt.date.fromisoformat(first), dt.date.fromisoformat(last)
    return [(a + dt.timedelta(days=k)).isoformat() for k in range((b - a).days + 1)]


def write_jdbc(df: DataFrame, url: str, table: str, properties: dict[str, str]) -> None:
    df.write.option("batchsize", 2000).jdbc(url, table, mode="overwrite", properties=properties)
