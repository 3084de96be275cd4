"""Time bins, interval predicates and the gap arithmetic of log replay.

Times are handled as microseconds. Lines of one file may be very many, so nothing here gathers
a file in one task: per-file facts are aggregates, and gaps are taken inside ranges of line
numbers with the range edges joined back in.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from logspark.functions.joins import small_enough
from logspark.operators.decode import known_time, repair_json
from logspark.session import scratch_path

RANGE_LINES = 1_000_000


def micros(ts: Column) -> Column:
    return F.unix_micros(ts)


# --- bins -------------------------------------------------------------------------------------


def bin_count(begin: Column, end: Column, size_us: int) -> Column:
    """Bins needed to cover a period: the period divided by the size, rounded up."""
    period = micros(end) - micros(begin)
    return F.ceil(period / F.lit(size_us)).cast("bigint")


def locate_bin(ts: Column, begin: Column, end: Column, size_us: int) -> Column:
    """Bin of a time. Bins are anchored at the end of the period, and division truncates."""
    back = F.call_function("div", micros(end) - micros(ts), F.lit(size_us).cast("bigint"))
    return bin_count(begin, end, size_us) - back - 1


def bin_bounds(df: DataFrame, begin: str, end: str, size_us: int, out: str = "bound") -> DataFrame:
    """One row per bound: begin, begin + size, … up to the end."""
    steps = F.sequence(micros(F.col(begin)), micros(F.col(end)), F.lit(size_us).cast("bigint"))
    return df.withColumn(out, F.explode(steps)).withColumn(out, F.timestamp_micros(F.col(out)))


# --- intervals: every comparison is strict ----------------------------------------------------


def time_in_range(t: Column, begin: Column, end: Column) -> Column:
    return (t > begin) & (t < end)


def fully_in_range(a_begin: Column, a_end: Column, begin: Column, end: Column) -> Column:
    return time_in_range(a_begin, begin, end) & time_in_range(a_end, begin, end)


def tail_in_range(a_begin: Column, a_end: Column, begin: Column, end: Column) -> Column:
    return (a_end > begin) & (a_begin < end) & (a_begin < begin)


def head_in_range(a_begin: Column, a_end: Column, begin: Column, end: Column) -> Column:
    return (a_begin < end) & (a_begin > begin) & (a_end > end)


def contains_range(a_begin: Column, a_end: Column, begin: Column, end: Column) -> Column:
    return time_in_range(begin, a_begin, a_end) & time_in_range(end, a_begin, a_end)


def interval_in_range(a_begin: Column, a_end: Column, begin: Column, end: Column) -> Column:
    args = (a_begin, a_end, begin, end)
    return fully_in_range(*args) | head_in_range(*args) | tail_in_range(*args) | contains_range(*args)


def classify_partial(a_begin: Column, a_end: Column, begin: Column, end: Column) -> Column:
    """middle, head or tail; ``complete`` also stands for "not at all"."""
    args = (a_begin, a_end, begin, end)
    return (
        F.when(contains_range(*args), "middle")
        .when(head_in_range(*args), "head")
        .when(tail_in_range(*args), "tail")
        .otherwise("complete")
    )


def parse_interval(df: DataFrame, begin: str, end: str, fmt: str = "yyyy-MM-dd HH:mm:ss") -> DataFrame:
    """Add beginning, end_time, period_us and ``_error`` from two texts."""
    b, e = (F.try_to_timestamp(F.col(c), F.lit(fmt)) for c in (begin, end))
    error = F.when(b.isNull(), F.lit("bad beginning")).when(e.isNull(), F.lit("bad end")).when(
        e < b, F.lit("end before beginning")
    )
    return df.select(
        "*",
        b.alias("beginning"),
        e.alias("end_time"),
        F.when(error.isNull(), micros(e) - micros(b)).alias("period_us"),
        error.alias("_error"),
    )


# --- replay -----------------------------------------------------------------------------------


def seek(lines: DataFrame, files: DataFrame, begin: Column, end: Column) -> DataFrame:
    """Per file: overlap class and the line range to read.

    ``lines``: path, offset, ts. ``files``: path, first_ts, last_ts, lines. The start is the first
    line after the beginning (tail, middle), the end the first line after the end (head, middle)
    and is inclusive. Other files keep their full range.
    """
    kinds = files.select("path", "lines", classify_partial(F.col("first_ts"), F.col("last_ts"), begin, end).alias("partial"))
    ts = F.col("ts")
    edges = lines.groupBy("path").agg(
        F.min(F.when(ts > begin, F.col("offset"))).alias("__from"),
        F.min(F.when(ts > end, F.col("offset"))).alias("__to"),
    )
    out = kinds.join(edges, "path", "left")
    starts = F.col("partial").isin("tail", "middle")
    stops = F.col("partial").isin("head", "middle")
    return out.select(
        "path",
        "partial",
        F.when(starts, F.coalesce("__from", F.lit(0))).otherwise(F.lit(0)).cast("bigint").alias("beginning"),
        F.when(stops, F.coalesce("__to", F.col("lines"))).otherwise(F.col("lines")).cast("bigint").alias("end"),
    )


ZONE_COLUMNS = "path STRING, zone STRING, min_ts TIMESTAMP, max_ts TIMESTAMP, first BIGINT"
ZONE_LINES = "path STRING, offset BIGINT, ts TIMESTAMP, zone STRING, slot INT"
# zones lie in at most so many folders, of one file each
ZONE_SLOTS = 1024


def zone_slot() -> Column:
    return F.pmod(F.xxhash64("zone"), F.lit(ZONE_SLOTS)).cast("int").alias("slot")


def write_zones(timed: DataFrame, folder: str, zone_lines: int = RANGE_LINES) -> None:
    """Keep the times of lines (path, offset, ts) by zones of so many lines of a file, with the span of each zone.

    Lines that could not be read and lines without a time are left out; they start and end nothing. Zones are dealt to a
    fixed number of folders: many short files have many small zones, and a folder for each would cost more than its lines.
    """
    known = timed.filter("_error IS NULL") if "_error" in timed.columns else timed
    zone = F.concat_ws("-", F.hex(F.xxhash64("path")), F.expr(f"offset div {zone_lines}").cast("string"))
    lines = known.filter(F.col("ts").isNotNull()).select("path", "offset", "ts", zone.alias("zone"))
    lines = lines.select("*", zone_slot())
    lines.repartition("slot").sortWithinPartitions("slot", "zone", "offset").write.partitionBy("slot").parquet(f"{folder}/lines")
    written = timed.sparkSession.read.schema(ZONE_LINES).parquet(f"{folder}/lines")
    spans = written.groupBy("path", "zone").agg(F.min("ts").alias("min_ts"), F.max("ts").alias("max_ts"), F.min("offset").alias("first"))
    spans.write.parquet(f"{folder}/zones")


def seek_zones(folder: str, files: DataFrame, begin: Column, end: Column) -> DataFrame:
    """``seek`` over what ``write_zones`` kept: only the folders of zones in which a start or an end can lie are read.

    These zones are, for each file, the first zone with a line after the beginning and the first with one after the end.
    """
    spark = files.sparkSession
    zones = spark.read.schema(ZONE_COLUMNS).parquet(f"{folder}/zones")
    reaching = lambda t: F.min(F.when(F.col("max_ts") > t, F.struct("first", "zone")))["zone"]
    wanted = zones.groupBy("path").agg(F.array_distinct(F.array_compact(F.array(reaching(begin), reaching(end)))).alias("z"))
    wanted = wanted.select(F.explode("z").alias("zone")).select("zone", zone_slot())
    lines = spark.read.schema(ZONE_LINES).parquet(f"{folder}/lines")
    # a join with few zones: Spark reads the folders of those zones only
    return seek(lines.join(small_enough(wanted), ["slot", "zone"]), files, begin, end)


def timed_lines(lines: DataFrame, col: str = "value") -> DataFrame:
    """Parse each line's known time, repairing broken escapes first.

    Adds ``ts``, ``broken``, ``fixed`` and ``_error``; the caller decides whether rejects stop a job.
    """
    fixed = repair_json(lines, col).withColumnRenamed("_error", "__json")
    timed = known_time(fixed, col).withColumnRenamed("known_time", "ts")
    return timed.withColumn("_error", F.coalesce("__json", "_error")).drop("__json")


def replay_gaps(timed: DataFrame, range_lines: int = RANGE_LINES) -> DataFrame:
    """``gap_us`` to the previous readable line of the same file; 0 for the first.

    Lines are cut into ranges of line numbers. A window handles each range; the last time of each
    range, one row per range, is handed to the range after it. A line without time has a null gap,
    and so does the line after it. The readable lines are written once below the shared folder, as
    they are gone through twice: their text is parsed once.
    """
    rows = timed.filter(F.col("_error").isNull()) if "_error" in timed.columns else timed
    held = scratch_path(timed.sparkSession, "timed")
    rows.withColumn("__range", F.expr(f"offset div {range_lines}")).write.parquet(held)
    rows = timed.sparkSession.read.parquet(held)
    w = Window.partitionBy("path", "__range").orderBy("offset")
    first = F.row_number().over(w) == 1
    rows = rows.withColumn("__prev", F.lag("ts").over(w)).withColumn("__first", first)
    # ranges may be empty of readable lines, so "previous" means previous range that has any
    ends = rows.groupBy("path", "__range").agg(F.max_by("ts", "offset").alias("__last"))
    over = Window.partitionBy("path").orderBy("__range")
    ends = ends.select(
        "path",
        "__range",
        F.lag("__last").over(over).alias("__carry"),
        (F.row_number().over(over) == 1).alias("__head"),
    )
    # the windows have put the rows in this order already, so the join needs neither a size test nor a shuffle of rows
    joined = rows.join(ends, ["path", "__range"])
    prev = F.when(F.col("__first"), F.col("__carry")).otherwise(F.col("__prev"))
    gap = micros(F.col("ts")) - micros(prev)
    zero = F.col("__first") & F.col("__head")
    return joined.withColumn("gap_us", F.when(zero, F.lit(0)).otherwise(gap).cast("bigint")).drop(
        "__range", "__prev", "__first", "__carry", "__head"
    )


def file_gaps(files: DataFrame) -> DataFrame:
    """``gap_us`` between the end of the previous file of a folder and the start of this one.

    One row per file; files are ordered by their beginning. The first file of a folder has none.
    """
    w = Window.partitionBy("dir").orderBy("first_ts", "path")
    return files.withColumn(
        "gap_us", (micros(F.col("first_ts")) - micros(F.lag("last_ts").over(w))).cast("bigint")
    )


def start_gap(timed: DataFrame, files: DataFrame, begin: Column) -> DataFrame:
    """Per folder: the first enabled file and the wait before its first line is due.

    ``files``: dir, path, first_ts, beginning (start offset), enabled.
    """
    first = (
        files.filter("enabled")
        .groupBy("dir")
        .agg(F.min_by(F.struct("path", "beginning"), F.struct("first_ts", "path")).alias("f"))
        .select("dir", "f.path", F.col("f.beginning").alias("offset"))
    )
    at = timed.select("path", "offset", "ts").join(small_enough(first), ["path", "offset"])
    return at.select("dir", "path", "offset", (micros(F.col("ts")) - micros(begin)).alias("gap_us"))


