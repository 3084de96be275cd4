"""Indicator lists: validation, registration, switching and IDS rule text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from logspark import fixed
from logspark.functions.ip import canon_ip
from logspark.functions.joins import small_enough
from logspark.functions.ranks import global_rank

BUCKET_ROWS = 1_000_000


def validate_iocs(df: DataFrame) -> DataFrame:
    """Add ``_error``: type and value must be set, IP types need an address, six types exist."""
    kind, value = F.coalesce("type", F.lit("")), F.coalesce("value", F.lit(""))
    ip_type = kind.isin("src_ip", "dest_ip")
    error = (
        F.when(kind == "", F.lit("missing IoC type"))
        .when(value == "", F.lit("missing IoC value"))
        .when(ip_type & canon_ip(value).isNull(), F.lit("invalid IP addr"))
        .when(~kind.isin(*fixed.INDICATOR_TYPES), F.lit("unsupported item type"))
    )
    return df.withColumn("_error", error)


def register_iocs(new: DataFrame, prior: DataFrame, now: Column, seq: str = "seq") -> tuple[DataFrame, DataFrame]:
    """Return (registry, answers).

    ``registry``: prior plus one row per new (type, value) in order of arrival (``seq``), with the
    next ids, enabled. ``answers``: every input row with the id it got or already had.
    """
    first = new.groupBy("type", "value").agg(F.min(seq).alias(seq))
    fresh = first.join(prior.select("type", "value"), ["type", "value"], "left_anti")
    # arrival numbers are cut in ranges, so no task numbers more than one range
    ranked = global_rank(fresh, F.expr(f"`{seq}` div {BUCKET_ROWS}"), [F.col(seq), F.col("type"), F.col("value")], "rank")
    base = prior.agg(F.coalesce(F.max("id") + 1, F.lit(0)).cast("bigint")).scalar()
    added = ranked.select(
        (F.col("rank") + base).alias("id"),
        F.lit(True).alias("enabled"),
        "value",
        "type",
        now.alias("added"),
    )
    registry = prior.select("id", "enabled", "value", "type", "added").unionByName(added)
    answers = new.join(small_enough(registry.select("type", "value", "id")), ["type", "value"], "left")
    return registry, answers


def set_enabled(iocs: DataFrame, changes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Apply (id, enabled, seq) rows; the latest change of an id counts.

    Returns the new list and the ids that do not exist.
    """
    flags = changes.groupBy("id").agg(F.max_by("enabled", F.col("seq")).alias("__flag"))
    out = iocs.join(small_enough(flags), "id", "left")
    out = out.withColumn("enabled", F.coalesce("__flag", "enabled")).select(*iocs.columns)
    return out, flags.select("id").join(iocs.select("id"), "id", "left_anti")


def type_rank() -> Column:
    """Position of the type in the listing order."""
    return F.array_position(F.array(*[F.lit(name) for name in fixed.INDICATOR_TYPES]), F.col("type")).cast("int")


def list_iocs(iocs: DataFrame) -> DataFrame:
    """Rows in type order, then by id; the column ``type_rank`` carries the order."""
    return iocs.withColumn("type_rank", type_rank()).orderBy("type_rank", "id")


def ioc_counts(iocs: DataFrame) -> DataFrame:
    return iocs.agg(
        F.count(F.lit(1)).alias("total"), F.coalesce(F.max("id") + 1, F.lit(0)).cast("bigint").alias("next_id")
    )


def ioc_rules(iocs: DataFrame) -> DataFrame:
    """One row per rule line: id, line_no, rule. Disabled indicators give commented lines."""
    mark = F.when(F.col("enabled"), F.lit("")).otherwise(F.lit("# "))
    sid = F.col("id") + F.lit(fixed.RULE_SID_OFFSET)

    def line(template: str, value_first: bool, second: bool = False) -> Column:
        args = [F.col("value"), F.col("value"), F.col("type")] if value_first else [
            F.col("type"), F.col("value"), F.col("value")
        ]
        number = sid + fixed.RULE_SECOND_SID_OFFSET if second else sid
        body = F.format_string(template, *args, number, F.lit(fixed.RULE_REVISION), F.lit(fixed.RULE_METADATA))
        return F.concat(mark, body)

    kind = F.col("type")
    lines = (
        F.when(kind == "src_ip", F.array(line(fixed.RULE_SRC_IP, True)))
        .when(kind == "dest_ip", F.array(line(fixed.RULE_DEST_IP, True)))
        .when(
            kind == "tls.ja3.hash",
            F.array(line(fixed.RULE_JA3, False), line(fixed.RULE_JA3_INBOUND, False, second=True)),
        )
        .when(kind == "tls.ja3s.hash", F.array(line(fixed.RULE_JA3S, False)))
        .when(kind == "tls.sni", F.array(line(fixed.RULE_TLS_SNI, False)))
        .when(kind == "http.hostname", F.array(line(fixed.RULE_HTTP_HOST, False)))
        .otherwise(F.array(F.concat(F.lit("# unsupported ioc type for "), F.col("id").cast("string"))))
    )
    return iocs.select("id", F.posexplode(lines).alias("line_no", "rule"))
