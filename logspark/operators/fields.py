"""What each kind of event says about itself, as Columns over a decoded frame.

All take the columns left by ``decode``: ``kind``, ``v`` and ``rec``.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from logspark.fixed import AUDIT_FIELDS, SYSMON_SOURCE
from logspark.functions.dynamic import dot_number, dot_string, number_sql, text_sql
from logspark.functions.ip import canon_ip
from logspark.functions.times import plain_time, rfc3339


def _kinds(suricata: Column, windows: Column, syslog: Column, snoopy: Column) -> Column:
    kind = F.col("kind")
    return (
        F.when(kind == "suricata", suricata)
        .when(kind.isin("windows", "sysmon"), windows)
        .when(kind == "syslog", syslog)
        .when(kind == "snoopy", snoopy)
    )


def rec(name: str) -> Column:
    return F.col("rec")[name]


def event_time() -> Column:
    """``@timestamp`` of the event; null when missing or unreadable."""
    stamp = rfc3339(dot_string("v", "@timestamp", strict=True))
    return _kinds(stamp, stamp, rec("timestamp"), rec("timestamp"))


def source() -> Column:
    return _kinds(
        F.coalesce(dot_string("v", "event_type", strict=True), F.lit("")),
        F.coalesce(dot_string("v", "winlog.channel", strict=True), F.lit("")),
        rec("syslog_program"),
        rec("username"),
    )


def sender() -> Column:
    return _kinds(
        F.coalesce(dot_string("v", "host", strict=True), F.lit("")),
        F.coalesce(dot_string("v", "winlog.computer_name", strict=True), F.lit("")),
        rec("syslog_host"),
        rec("syslog_host"),
    )


def legacy_source() -> Column:
    """Emitting program of a flat Windows event record held in ``v``."""
    return F.coalesce(
        dot_string("v", "SourceName", strict=True), dot_string("v", "syslog_program", strict=True), F.lit("")
    )


def legacy_sender() -> Column:
    return F.coalesce(dot_string("v", "Hostname", strict=True), dot_string("v", "syslog_host", strict=True), F.lit(""))


def legacy_sender_ip() -> Column:
    return canon_ip(dot_string("v", "syslog_ip", strict=True))


def legacy_time() -> Column:
    """Sysmon records count from their receipt, all others from the event itself."""
    received = dot_string("v", "EventReceivedTime", strict=True)
    happened = dot_string("v", "EventTime", strict=True)
    return plain_time(F.when(legacy_source() == SYSMON_SOURCE, received).otherwise(happened))


def cef_source() -> Column:
    return F.col("DeviceProduct")


def cef_sender() -> Column:
    return F.col("DeviceVendor")


def honeypot_source() -> Column:
    return F.coalesce(F.col("Extensions")["dntdom"], F.col("DeviceProduct"))


def honeypot_sender() -> Column:
    return F.coalesce(F.col("Extensions")["dvchost"], F.col("DeviceVendor"))


# Names under which syslog and audit fields may be asked for.
SYSLOG_ALIASES = {
    "timestamp": ("timestamp", "@timestamp", "Time", "time"),
    "syslog_host": ("syslog_host", "host", "Host"),
    "syslog_program": ("syslog_program", "program", "Program"),
    "syslog_severity": ("syslog_severity", "severity", "Severity"),
    "syslog_facility": ("syslog_facility", "facility", "Facility"),
    "syslog_message": ("syslog_message", "message", "Message"),
    "syslog_ip": ("syslog_ip", "ip", "IP"),
}
SSH_ALIASES = {
    "dst_port": ("dst_port", "dest_port", "dport"),
    "dst_ip": ("dst_ip", "dest_ip"),
    "src_port": ("src_port", "sport"),
    "src_ip": ("src_ip",),
}
_SYSLOG_BY_ALIAS = {alias: name for name, aliases in SYSLOG_ALIASES.items() for alias in aliases}
_SSH_BY_ALIAS = {f"ssh.{alias}": name for name, aliases in SSH_ALIASES.items() for alias in aliases}


def select_sql(kind: str, key: str, number: bool = False) -> str | None:
    """SQL text of one field of one kind, null for names that kind never has."""
    if kind in ("suricata", "windows", "sysmon"):
        return number_sql("v", key) if number else text_sql("v", key)
    if kind == "snoopy":
        if key in AUDIT_FIELDS:
            return f"rec.{key if key != 'group' else '`group`'}"
        if key in _SSH_BY_ALIAS:
            return f"rec.ssh.{_SSH_BY_ALIAS[key]}"
    name = _SYSLOG_BY_ALIAS.get(key)
    if name == "timestamp":
        return "date_format(rec.timestamp, \"yyyy-MM-dd HH:mm:ss.SSSSSS '+0000 UTC'\")"
    return f"rec.{name}" if name else None


def select_field(key: str) -> Column:
    """Value of a named field as text, whatever the kind of the row."""
    branches = []
    for kind in ("suricata", "windows", "sysmon", "syslog", "snoopy"):
        sql = select_sql(kind, key)
        if sql is not None:
            branches.append(f"WHEN kind = '{kind}' THEN {sql}")
    return F.expr("CASE " + " ".join(branches) + " END")


def keywords() -> Column:
    """Free text that rules may search, null when there is none."""
    alert = dot_string("v", "event_type", strict=True) == "alert"
    suricata = F.array_compact(
        F.array(
            F.when(alert, dot_string("v", "alert.signature_id")),
            F.when(alert, dot_string("v", "alert.category")),
            F.when(dot_string("v", "event_type", strict=True).isNotNull(), dot_string("v", "payload_printable", strict=True)),
        )
    )
    message = dot_string("v", "message", strict=True)
    return _kinds(
        F.when(F.size(suricata) > 0, suricata),
        F.when(message.isNotNull(), F.array(message)),
        F.array(rec("syslog_message")),
        F.array(rec("cmd")),
    )


def event_data(use_signature: bool = False) -> Column:
    """STRUCT<ID, Key, Fields> digest.

    The alert's name is looked up in its numeric id, so normally only the category is listed;
    ``use_signature`` lists the signature text as well.
    """
    event_type = dot_string("v", "event_type", strict=True)
    alert = event_type == "alert"
    name = dot_string("v", "alert.signature") if use_signature else dot_string("v", "alert.signature_id")
    has_id = F.expr("try_variant_get(v, '$.alert.signature_id', 'variant')").isNotNull()
    listed = alert & has_id
    empty = F.array().cast("array<string>")

    def digest(code: Column, key: Column, fields: Column) -> Column:
        return F.struct(
            F.coalesce(code, F.lit(0)).cast("bigint").alias("ID"), key.alias("Key"), fields.alias("Fields")
        )

    suricata = F.when(
        event_type.isNotNull(),
        digest(
            F.when(listed, dot_number("v", "alert.signature_id")).cast("bigint"),
            event_type,
            F.when(listed, F.array_compact(F.array(name, dot_string("v", "alert.category")))).otherwise(empty),
        ),
    )
    windows = digest(
        dot_number("v", "winlog.event_id").cast("bigint"),
        F.coalesce(dot_string("v", "winlog.channel", strict=True), F.lit("")),
        F.array_compact(
            F.array(
                *[
                    dot_string("v", path)
                    for path in ("process.name", "winlog.event_data.TargetImage", "winlog.task", "winlog.user.name")
                ]
            )
        ),
    )
    syslog = digest(F.lit(0), rec("syslog_program"), F.array(rec("syslog_message")))
    snoopy = digest(F.lit(0), rec("filename"), F.array(rec("cmd"), rec("cwd"), rec("username")))
    return _kinds(suricata, windows, syslog, snoopy)
