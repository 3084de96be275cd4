"""Raw topic lines to typed JSON: payload dispatch and per-kind routing."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from logspark.fixed import AUDIT_FIELDS, CEF_HOSTS
from logspark.functions.binding import with_fields
from logspark.functions.dynamic import parse_object
from logspark.functions.times import rfc3339_text
from logspark.operators.audit import parse_snoopy
from logspark.operators.cef import CEF_COLUMNS, parse_cef
from logspark.operators.syslog import cee_payload, is_cee, parse_rfc5424

MARK = "LOGSTASH[-]:"


def payload_type(host: Column, program: Column, message: Column) -> Column:
    """Which of the five payloads a parsed syslog message carries."""
    return (
        F.when(is_cee(message) & (program == "suricata"), "cee_suricata")
        .when(is_cee(message), "cee_windows")
        .when(program == "snoopy", "snoopy")
        .when((program == "CEF") & host.isin(*CEF_HOSTS), "cef")
        .otherwise("syslog")
    )


def syslog_json_fields() -> list[Column]:
    return [
        rfc3339_text(F.col("event_time")).alias("@timestamp"),
        *[
            F.col(name)
            for name in ("syslog_host", "syslog_program", "syslog_severity", "syslog_facility", "syslog_message")
        ],
    ]


def audit_json_fields() -> list[Column]:
    """Audit fields; empty ones are left out of the JSON, as null struct fields are."""
    return [F.when(F.col(name) != "", F.col(name)).alias(name) for name in AUDIT_FIELDS] + [F.col("ssh")]


def normalize_syslog(
    df: DataFrame, col: str = "value", now: Column | None = None, keep: tuple[str, ...] = ()
) -> DataFrame:
    """Parse lines and their payload: adds ``payload_type``, the parsed columns and ``json``.

    Plain syslog and command-audit rows leave the job. CEE and CEF payloads are rejects
    unless named in ``keep``, in which case their parsed form becomes ``json``.
    """
    parsed = parse_rfc5424(df, col, now)
    parsed = parsed.withColumnRenamed("_error", "__line")
    found = payload_type(F.col("syslog_host"), F.col("syslog_program"), F.col("syslog_message"))
    parsed = with_fields(parsed, [F.when(F.col("__line").isNull(), found).alias("payload_type")])
    kind = F.col("payload_type")
    parsed = parsed.withColumn("__audit_in", F.when(kind == "snoopy", F.col("syslog_message")))
    parsed = parse_snoopy(parsed, "__audit_in", error="__audit")
    cee = cee_payload(F.col("syslog_message"))
    unsupported = F.lit("unsupported payload")
    bad_cee = parse_object("__cee").isNull()
    parsed = with_fields(parsed, [cee.alias("__cee")])
    if "cef" in keep:
        parsed = parsed.withColumn("__cef_in", F.when(kind == "cef", F.col("syslog_message")))
        parsed = parse_cef(parsed, "__cef_in", error="__cef")
        cef_error = F.col("__cef")
        cef_json = F.to_json(
            F.struct(*syslog_json_fields(), F.struct(*CEF_COLUMNS, "Extensions").alias("cef"))
        )
    else:
        cef_error, cef_json = unsupported, F.lit(None).cast("string")

    def cee_error(name: str) -> Column:
        if name not in keep:
            return unsupported
        return F.when(bad_cee, F.lit("payload is not a JSON object"))

    error = (
        F.when(F.col("__line").isNotNull(), F.col("__line"))
        .when(kind == "snoopy", F.col("__audit"))
        .when(kind == "cef", cef_error)
        .when(kind == "cee_suricata", cee_error("cee_suricata"))
        .when(kind == "cee_windows", cee_error("cee_windows"))
    )
    json = (
        F.when(kind == "syslog", F.to_json(F.struct(*syslog_json_fields())))
        .when(kind == "snoopy", F.to_json(F.struct(*audit_json_fields(), *syslog_json_fields())))
        .when(kind == "cef", cef_json)
        .otherwise(F.col("__cee"))
    )
    parsed = with_fields(parsed, [error.alias("_error")])
    parsed = with_fields(parsed, [F.when(F.col("_error").isNull(), json).alias("json")])
    return parsed.drop("__line", "__audit_in", "__audit", "__cee", "__cef_in", "__cef")


def unwrap_suricata(df: DataFrame, col: str = "value") -> DataFrame:
    """Raw EVE JSON carried in a syslog message, as column ``json``; ``_error`` on a bad line."""
    parsed = parse_rfc5424(df, col, F.lit(None).cast("timestamp"))
    message = F.col("syslog_message")
    at = F.instr(message, MARK)
    text = F.ltrim(F.when(at > 0, F.substr(message, at + len(MARK))).otherwise(message))
    error = F.coalesce(F.col("_error"), F.when(message == "", F.lit("no message")))
    return parsed.select(
        *df.columns, F.when(error.isNull(), text).alias("json"), error.alias("_error")
    )


def preprocess(df: DataFrame, now: Column | None = None) -> DataFrame:
    """Route enveloped raw lines by ``kind``; returns source kind, output ``kind``, ``value``, ``_error``.

    One pass: the header of syslog, audit and Suricata lines is parsed once. Windows lines pass
    unchanged. Other kinds are dropped. The output kind follows what was found in the line, so a
    syslog topic may yield audit rows.
    """
    rows = df.filter(F.col("kind").isin("syslog", "snoopy", "windows", "suricata"))
    wrapped = F.col("kind") != "windows"
    rows = rows.withColumn("__line_in", F.when(wrapped, F.col("value")))
    parsed = normalize_syslog(rows, "__line_in", now)
    message = F.col("syslog_message")
    at = F.instr(message, MARK)
    eve = F.ltrim(F.when(at > 0, F.substr(message, at + len(MARK))).otherwise(message))
    suricata = F.col("kind") == "suricata"
    windows = F.col("kind") == "windows"
    header_ok = F.col("syslog_host").isNotNull()
    error = (
        F.when(windows, F.lit(None).cast("string"))
        .when(
            suricata,
            F.when(~header_ok, F.col("_error")).when(message == "", F.lit("no message")),
        )
        .otherwise(F.col("_error"))
    )
    value = F.when(windows, F.col("value")).when(suricata, eve).otherwise(F.col("json"))
    out_kind = F.when(windows | suricata, F.col("kind")).otherwise(F.col("payload_type"))
    carried = [c for c in df.columns if c not in ("kind", "value")]
    return parsed.select(
        *carried,
        F.col("kind").alias("source_kind"),
        F.when(error.isNull(), out_kind).alias("kind"),
        F.when(error.isNull(), value).otherwise(F.col("value")).alias("value"),
        error.alias("_error"),
    )
