"""JSON events to typed columns.

``decode`` parses each row once into VARIANT ``v``; syslog and command-audit events also get
the struct ``rec``. Everything later reads these two columns.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from logspark.fixed import AUDIT_FIELDS, DYNAMIC_KINDS, SYSLOG_FIELDS, SYSMON_CHANNEL
from logspark.functions.binding import with_fields
from logspark.functions.dynamic import dot_number, dot_string, json_path, parse_object
from logspark.functions.ip import canon_ip
from logspark.functions.times import offset_text, offset_time, plain_time, rfc3339
from logspark.schemas import KNOWN_TIMES, ZEEK_NOTE

# Escape sequences that some senders write although JSON has none of them.
BROKEN_ESCAPES = r"\\([()*])"


def repaired_text(col: Column) -> Column:
    return F.regexp_replace(col, BROKEN_ESCAPES, "$1")


def repair_json(df: DataFrame, col: str = "value") -> DataFrame:
    """Undo broken escapes, only where the text does not decode as it is.

    Adds ``broken`` and ``fixed`` flags; a row still broken keeps its text and gets ``_error``.
    """
    out = with_fields(df, [parse_object(col).isNull().alias("broken")])
    out = with_fields(out, [F.when(F.col("broken"), repaired_text(F.col(col))).alias("__r")])
    out = with_fields(out, [(F.col("broken") & parse_object("__r").isNotNull()).alias("fixed")])
    return out.select(
        *[c for c in df.columns if c != col],
        F.when(F.col("fixed"), F.col("__r")).otherwise(F.col(col)).alias(col),
        "broken",
        "fixed",
        F.when(F.col("broken") & ~F.col("fixed"), F.lit("not a JSON object")).alias("_error"),
    )


def known_time(df: DataFrame, col: str = "value", prefer_syslog: bool = False) -> DataFrame:
    """``known_time``: receipt time, else event time, else sensor time, else ``@timestamp``.

    A field that is present must parse, or the row is a reject.
    """
    whole = F.when(parse_object(col).isNotNull(), F.col(col))
    out = with_fields(df, [F.from_json(whole, KNOWN_TIMES).alias("__o")])
    fields = {
        "EventReceivedTime": plain_time,
        "EventTime": plain_time,
        "timestamp": offset_time,
        "@timestamp": rfc3339,
    }
    parsed = {name: parse(F.col("__o")[name]) for name, parse in fields.items()}
    error = F.when(F.col("__o").isNull(), F.lit("not a JSON object"))
    for name in fields:
        error = error.when(F.col("__o")[name].isNotNull() & parsed[name].isNull(), F.lit(f"bad {name}"))
    best = parsed["@timestamp"] if prefer_syslog else F.coalesce(*parsed.values())
    out = with_fields(out, [error.alias("_error")], [*df.columns, "__o"])
    return with_fields(out, [F.when(F.col("_error").isNull(), best).alias("known_time")], [*df.columns, "_error"])


def suricata_ts(col: Column) -> Column:
    """Re-print a sensor time with six fraction digits and a numeric offset (UTC)."""
    return offset_text(offset_time(col, zulu=True))


def is_alert(col: Column) -> Column:
    """Alert test on raw text; cheap enough to run before any full decode."""
    return F.coalesce(F.get_json_object(col, "$.event_type") == "alert", F.lit(False))


def _present(path: str) -> Column:
    """Whether ``v`` has a value at a path, JSON null not counted; any value prints as text."""
    return F.expr(f"try_variant_get(v, '{json_path(path.split('.'))}', 'string')").isNotNull()


def _is_object(path: str) -> Column:
    """Whether ``v`` has an object at a path; its type is only asked for where something is."""
    kind = F.expr(f"schema_of_variant(try_variant_get(v, '{json_path(path.split('.'))}', 'variant'))")
    return _present(path) & F.startswith(kind, F.lit("OBJECT"))


def _text(path: str) -> Column:
    return F.coalesce(dot_string("v", path, strict=True), F.lit(""))


def _record() -> Column:
    """Struct of syslog and command-audit fields; a missing text is empty, as in the wire format."""
    plain = [name for name in SYSLOG_FIELDS if name != "syslog_ip"] + list(AUDIT_FIELDS)
    ssh = F.when(
        _is_object("ssh"),
        F.struct(
            *[_text(f"ssh.{name}").alias(name) for name in ("dst_port", "src_port")],
            *[canon_ip(_text(f"ssh.{name}")).alias(name) for name in ("dst_ip", "src_ip")],
            *[_present(f"ssh.{name}").alias(f"has_{name}") for name in ("dst_ip", "src_ip")],
        ),
    )
    return F.struct(
        rfc3339(dot_string("v", "@timestamp", strict=True)).alias("timestamp"),
        *[_text(name).alias(name) for name in plain],
        canon_ip(_text("syslog_ip")).alias("syslog_ip"),
        ssh.alias("ssh"),
    )


def decode(df: DataFrame, col: str = "value") -> DataFrame:
    """Add ``v``, ``rec`` and ``_error``. Unknown kinds are rejects.

    Text fields of the struct kinds must be JSON strings; a number there rejects the row, as
    does a present but unreadable ``@timestamp``.
    """
    out = with_fields(df, [parse_object(col).alias("v")])
    struct_kind = F.col("kind").isin("syslog", "snoopy")
    texts = list(SYSLOG_FIELDS) + list(AUDIT_FIELDS)
    not_text = F.lit(False)
    for name in texts:
        not_text = not_text | (dot_string("v", name, strict=True).isNull() & _present(name))
    bad_time = rfc3339(dot_string("v", "@timestamp", strict=True)).isNull() & _present("@timestamp")
    error = (
        F.when(~F.coalesce(F.col("kind").isin(*DYNAMIC_KINDS) | struct_kind, F.lit(False)), F.lit("invalid kind"))
        .when(F.col("v").isNull(), F.lit("not a JSON object"))
        .when(struct_kind & not_text, F.lit("text field is not a string"))
        .when(struct_kind & bad_time, F.lit("bad @timestamp"))
    )
    out = with_fields(out, [error.alias("_error")])
    return with_fields(out, [F.when(F.col("_error").isNull() & struct_kind, _record()).alias("rec")])


def parse_zeek_notes(df: DataFrame, col: str = "value") -> DataFrame:
    """Typed projection of the 16 note fields plus event time, source and sender."""
    out = df.withColumn("__n", F.from_json(F.when(parse_object(col).isNotNull(), F.col(col)), ZEEK_NOTE))
    names = [part.rsplit(" ", 1)[0].strip().strip("`") for part in ZEEK_NOTE.split(", ")]
    addresses = {"id.orig_h", "id.resp_h", "src", "dst"}

    def field(name: str) -> Column:
        value = F.col("__n")[name]
        return (canon_ip(value) if name in addresses else value).alias(name)

    return out.select(
        *df.columns,
        *[field(name) for name in names],
        F.timestamp_seconds(F.col("__n")["ts"].cast("bigint")).alias("event_time"),
        canon_ip(F.col("__n")["id.orig_h"]).alias("source"),
        F.lit("cobalt").alias("sender"),
        F.when(F.col("__n").isNull(), F.lit("not a JSON object")).alias("_error"),
    )


def sysmon_process_network(df: DataFrame, col: str = "value", numeric_ids: bool = False) -> DataFrame:
    """Sysmon process-creation (1) and network (3) events.

    A text search runs first, so most rows are dropped before any JSON is decoded. Ids must be
    JSON strings unless ``numeric_ids`` is set.
    """
    out = df.filter(F.contains(F.col(col), F.lit(SYSMON_CHANNEL.split("/")[0])))
    out = with_fields(out, [parse_object(col).alias("v")])
    event_id = dot_string("v", "winlog.event_id", strict=True)
    if numeric_ids:
        event_id = F.coalesce(event_id, dot_number("v", "winlog.event_id", strict=True).cast("bigint").cast("string"))
    out = out.withColumn("sysmon_id", event_id)
    channel = dot_string("v", "winlog.channel", strict=True)
    return out.filter((channel == SYSMON_CHANNEL) & F.col("sysmon_id").isin("1", "3")).drop("v")


def sysmon_counts(selected: DataFrame) -> DataFrame:
    return selected.groupBy("sysmon_id").agg(F.count(F.lit(1)).alias("events"))
