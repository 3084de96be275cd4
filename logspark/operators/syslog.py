"""Syslog line jobs: RFC 5424 headers, CEE payloads, BSD lines and header repair."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from logspark.fixed import FACILITIES, SEVERITIES
from logspark.functions.binding import with_fields
from logspark.functions.times import rfc3339

SEP = "\x01"

# One pass over the line: the header fields are rewritten as a separated list. Header
# fields are printable ASCII, so the separator cannot occur in them; the message is last.
TOKEN = r"([\x21-\x7e]+)"
STRUCTURED = r'(?:-|(?:\[(?:[^\]\\"]|\\.|"(?:[^"\\]|\\.)*")*\])+)'
HEADER = (
    rf"(?s)^<(0|[1-9]\d{{0,2}})>[1-9]\d{{0,2}} {TOKEN} {TOKEN} {TOKEN} {TOKEN} {TOKEN} {STRUCTURED}(?: (.*))?\z"
)
REWRITE = "".join(f"{SEP}${n}" for n in (1, 2, 3, 4, 7))
# Partly valid lines, kept only on request: PRI, then whatever header fields are there.
LOOSE = r"(?s)^<(\d{1,3})>(?:\d{1,3} )?(\S+)? ?(\S+)? ?(\S+)? ?(.*)\z"
LOOSE_REWRITE = "".join(f"{SEP}${n}" for n in (1, 2, 3, 4, 5))


def _header(col: Column, pattern: str, rewrite: str) -> Column:
    """Array of pri, time, host, program, message; null when the line does not match.

    A line that matches starts with ``<``, its rewrite starts with the separator, and an
    unmatched line comes back unchanged, so the first character tells them apart.
    """
    done = F.regexp_replace(col, F.lit(pattern), F.lit(rewrite))
    return F.when(F.startswith(col, F.lit("<")) & F.startswith(done, F.lit(SEP)), F.split(done, SEP, 6))


def _label(code: Column, labels: tuple[str, ...]) -> Column:
    return F.get(F.array(*[F.lit(x) for x in labels]), code)


def parse_rfc5424(
    df: DataFrame, col: str = "value", now: Column | None = None, best_effort: bool = False
) -> DataFrame:
    """Add event_time and the five syslog text columns, or ``_error``.

    A ``-`` time becomes ``now``; a missing text field becomes ``""``. By default a partly
    valid header is a reject; ``best_effort`` keeps what could be read from it.
    """
    now = F.current_timestamp() if now is None else now
    parts = _header(F.col(col), HEADER, REWRITE)
    if best_effort:
        parts = F.coalesce(parts, _header(F.col(col), LOOSE, LOOSE_REWRITE))
    out = with_fields(df, [parts.alias("__p")])

    def part(i: int) -> Column:
        return F.get("__p", F.lit(i))

    def text(i: int) -> Column:
        return F.when(part(i) == "-", F.lit("")).otherwise(F.coalesce(part(i), F.lit("")))

    out = with_fields(out, [part(1).try_cast("int").alias("__pri"), rfc3339(part(2)).alias("__ts")])
    no_time = part(2) == "-"
    if best_effort:
        no_time = F.col("__ts").isNull()
    error = (
        F.when(F.col("__p").isNull(), F.lit("not an RFC 5424 line"))
        .when(F.col("__pri") > 191, F.lit("priority out of range"))
        .when(F.col("__ts").isNull() & ~no_time, F.lit("bad timestamp"))
    )
    out = with_fields(out, [error.alias("_error")])
    ok = F.col("_error").isNull()
    fields = [
        F.when(ok, F.coalesce("__ts", now)).alias("event_time"),
        F.when(ok, text(3)).alias("syslog_host"),
        F.when(ok, text(4)).alias("syslog_program"),
        F.when(ok, _label(F.col("__pri").bitwiseAND(F.lit(7)), SEVERITIES)).alias("syslog_severity"),
        F.when(ok, _label(F.shiftright("__pri", 3), FACILITIES)).alias("syslog_facility"),
        F.when(ok, F.coalesce(part(5), F.lit(""))).alias("syslog_message"),
    ]
    return with_fields(out, fields, [*df.columns, "_error"])


def is_cee(message: Column) -> Column:
    return message.rlike(r"^ ?@cee: ")


def cee_payload(message: Column) -> Column:
    """Payload after the CEE token, null when the message has none."""
    return F.when(is_cee(message), F.regexp_replace(message, r"^ ?@cee: ", ""))


BSD = r"(?s)^(?:<(\d+)>)?(\S+) (\S+) (\S+?)(?:\[(\d+)\])?:?( .+)\z"
BSD_REWRITE = "".join(f"{SEP}${n}" for n in range(1, 7))


def parse_bsd_syslog(df: DataFrame, col: str = "value") -> DataFrame:
    """pri, ts, host, program, pid, message and the re-printed line; ``_error`` on no match."""
    done = F.regexp_replace(F.col(col), F.lit(BSD), F.lit(BSD_REWRITE))
    matched = F.startswith(done, F.lit(SEP)) & ~F.startswith(F.col(col), F.lit(SEP))
    out = with_fields(df, [F.when(matched, F.split(done, SEP, 7)).alias("__p")])

    def part(i: int, default: str = "") -> Column:
        value = F.get("__p", F.lit(i))
        return F.when(value == "", F.lit(default)).otherwise(value)

    out = out.select(
        *df.columns,
        part(1, "1").alias("pri"),
        part(2).alias("ts"),
        part(3).alias("host"),
        part(4).alias("program"),
        part(5, "666").alias("pid"),
        F.regexp_replace(part(6), r"\s+$", "").alias("message"),
        F.when(F.col("__p").isNull(), F.lit("not a BSD syslog line")).alias("_error"),
    )
    # an explicit "<13>" keeps its digits only: the brackets are part of the template
    line = F.format_string("<%s>%s %s %s[%s]:%s", "pri", "ts", "host", "program", "pid", "message")
    return out.withColumn("line", F.when(F.col("_error").isNull(), line))


def fix_headers(df: DataFrame, col: str = "value") -> DataFrame:
    """Insert the missing ``collector imkafka`` fields after the second space."""
    fixed = F.regexp_replace(F.col(col), r"(?s)^([^ ]* [^ ]*) \s*", "$1 collector imkafka ")
    return df.withColumn(col, fixed)
