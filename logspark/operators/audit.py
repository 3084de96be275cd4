"""Command-audit lines: ``[key:value …]: command``."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from logspark.fixed import AUDIT_FIELDS, AUDIT_FIELDS_LONG, AUDIT_FIELDS_SHORT
from logspark.functions.binding import with_fields
from logspark.functions.ip import canon_ip

# A token runs to the next space; a parenthesis keeps spaces until it is closed.
TOKENS = r"([^ ()]*\([^)]*|[^ ()]+)"


def _after_colon(token: Column) -> Column:
    """Text after the first colon, empty without one."""
    return F.when(F.instr(token, ":") > 0, F.substr(token, F.instr(token, ":") + 1)).otherwise(F.lit(""))


def parse_snoopy(df: DataFrame, col: str = "syslog_message", error: str = "_error") -> DataFrame:
    """Add the ten audit fields, the ``ssh`` struct and an error column.

    Kept as observed in the field: the command keeps its leading space, the long form keeps
    the ``(`` of a parenthesised tty and the short form drops it, and one ``group:domain
    users`` is joined by an underscore.
    """
    message = F.ltrim(F.col(col))
    close = F.instr(message, "]")
    header = F.regexp_replace(F.substr(message, F.lit(1), close - 1), r"^\[+", "")
    # only the first occurrence is repaired
    at = F.instr(header, "group:domain users")
    header = F.when(
        at > 0,
        F.concat(F.substr(header, F.lit(1), at + 11), F.lit("_"), F.substr(header, at + 13)),
    ).otherwise(header)
    tail = F.substr(message, close)
    cmd = F.when(
        (F.instr(tail, ":") > 0) & (F.length(tail) > 3),
        F.regexp_replace(F.substr(tail, F.instr(tail, ":") + 1), r"\n+$", ""),
    ).otherwise(F.lit(""))

    out = with_fields(
        df,
        [
            message.alias("__m"),
            close.alias("__close"),
            F.regexp_extract_all(header, F.lit(TOKENS), F.lit(1)).alias("__t"),
            cmd.alias("__cmd"),
        ],
    )
    long, short = F.size("__t") == 10, F.size("__t") == 5
    reason = (
        F.when(~F.startswith("__m", F.lit("[")), F.lit("audit header missing"))
        .when(F.col("__close") == 0, F.lit("audit header not closed"))
        .when(~(long | short), F.lit("audit field count"))
    )

    def field(name: str) -> Column:
        value = F.lit("")
        if name in AUDIT_FIELDS_SHORT:
            token = _after_colon(F.get("__t", F.lit(AUDIT_FIELDS_SHORT.index(name))))
            if name == "tty":
                token = F.regexp_replace(token, r"^\(+", "")
            value = F.when(short, token).otherwise(value)
        if name in AUDIT_FIELDS_LONG:
            value = F.when(long, _after_colon(F.get("__t", F.lit(AUDIT_FIELDS_LONG.index(name))))).otherwise(value)
        return value

    parts = F.when(long, F.split(F.get("__t", F.lit(1)), r"\("))
    out = with_fields(out, [reason.alias("__e"), parts.alias("__ssh_text")])
    ssh_named = F.startswith(F.get("__ssh_text", F.lit(0)), F.lit("ssh")) & (F.size("__ssh_text") == 2)
    out = with_fields(out, [F.when(ssh_named, F.split(F.trim(F.get("__ssh_text", F.lit(1))), r"\s+")).alias("__ssh")])
    out = with_fields(out, [F.get("__ssh", F.lit(2)).alias("__dst"), F.get("__ssh", F.lit(0)).alias("__src")])
    has_ssh = F.coalesce(F.size("__ssh") == 4, F.lit(False))
    ok = F.col("__e").isNull() & F.col("__m").isNotNull()
    fields = {name: field(name) for name in AUDIT_FIELDS if name != "cmd"}
    fields["cmd"] = F.col("__cmd")
    columns = [
        *[F.when(ok, fields[name]).alias(name) for name in AUDIT_FIELDS],
        F.when(
            ok & has_ssh,
            F.struct(
                F.get("__ssh", F.lit(3)).alias("dst_port"),
                F.coalesce(canon_ip(F.col("__dst")), F.lit("")).alias("dst_ip"),
                F.get("__ssh", F.lit(1)).alias("src_port"),
                F.coalesce(canon_ip(F.col("__src")), F.lit("")).alias("src_ip"),
            ),
        ).alias("ssh"),
        F.col("__e").alias(error),
    ]
    return with_fields(out, columns, [c for c in df.columns if c != error])
