"""Exercise logs with short keys: rename, unescape, merge and split into streams."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from logspark.functions.binding import with_fields
from logspark.functions.dynamic import parse_object

# Short key of the old layout -> key of the new one.
RENAMED = {
    "@timestamp": "@timestamp",
    "host": "syslog_host",
    "program": "syslog_program",
    "severity": "syslog_severity",
    "facility": "syslog_facility",
    "ip": "syslog_ip",
}
AUDIT_SHORT = r"^\s?\[uid:(\d+) sid:(\d+) tty:(\S+) cwd:(\S+) filename:(\S+)\]: (.+)\z"
AUDIT_SHORT_KEYS = ("uid", "sid", "tty", "cwd", "filename", "cmd")
AUDIT_LONG = (
    r"^\s?\[login:(\S+) ssh:(\(.+?\)) username:(\S+) uid:(\d+) group:(\S+) gid:(\d+) "
    r"sid:(\d+) tty:(\S+) cwd:(\S+) filename:(\S+)\]: (.+)\z"
)
AUDIT_LONG_KEYS = ("login", "ssh", "username", "uid", "group", "gid", "sid", "tty", "cwd", "filename", "cmd")

FAMILIES = ("linux", "windows", "suricata")


def _pick(o: str, key: str) -> str:
    return f"try_element_at({o}, '{key}')"


def reformat(df: DataFrame, family: str, col: str = "value") -> DataFrame:
    """Add ``stream`` and replace ``value`` by the re-keyed JSON; ``_error`` on a bad line.

    linux: syslog and command-audit streams, the latter with its message parsed. windows and
    suricata: escaped quotes are undone, unknown keys are kept and a clash between a kept key
    and a new one rejects the line.
    """
    if family not in FAMILIES:
        raise ValueError(f"unknown family {family!r}")
    text = F.col(col)
    if family != "linux":
        text = F.replace(F.replace(text, F.lit('\\"'), F.lit('"')), F.lit("\\\\"), F.lit("\\"))
    out = with_fields(df, [text.alias("__t")])
    whole = F.when(parse_object("__t").isNotNull(), F.col("__t"))
    out = with_fields(out, [F.from_json(whole, "map<string,variant>").alias("__o")])
    has = lambda key: F.map_contains_key("__o", key)
    absent = F.lit(False)
    for key in RENAMED:
        absent = absent | ~has(key)

    base = [(new, F.expr(_pick("__o", old))) for old, new in RENAMED.items()]
    head = F.map_from_arrays(
        F.array(*[F.lit(new) for new, _ in base]), F.array(*[value for _, value in base])
    )
    message = F.when(
        has("message"), F.create_map(F.lit("syslog_message"), F.expr(_pick("__o", "message")))
    ).otherwise(F.expr("cast(map() as map<string,variant>)"))
    # JSON numbers in these two fields have no lower-case form and reject the line
    program = F.expr(f"CASE WHEN schema_of_variant({_pick('__o', 'program')}) = 'STRING' "
                     f"THEN lower(cast({_pick('__o', 'program')} as string)) END")
    error = F.when(F.col("__o").isNull(), F.lit("not a JSON object")).when(absent, F.lit("missing key"))

    if family == "linux":
        body = F.expr(f"cast({_pick('__o', 'message')} as string)")
        audit = F.contains(program, F.lit("snoopy"))
        error = error.when(program.isNull(), F.lit("missing key")).when(
            audit & ~has("message"), F.lit("missing key")
        )
        out = with_fields(out, [F.when(audit, body.rlike(AUDIT_SHORT)).alias("__short")])
        out = with_fields(out, [F.when(audit & ~F.col("__short"), body.rlike(AUDIT_LONG)).alias("__long")])
        ssh_text = F.regexp_extract(body, AUDIT_LONG, 2)
        ssh_parts = F.split(F.trim(F.regexp_replace(ssh_text, r"^\(+|\)+$", "")), r"\s+")
        ssh_known = ~F.contains(ssh_text, F.lit("undefined"))
        error = error.when(F.col("__long") & ssh_known & (F.size(ssh_parts) < 4), F.lit("ssh field count"))
        ssh = F.when(
            ssh_known,
            F.struct(
                *[
                    F.get(ssh_parts, F.lit(i)).alias(name)
                    for i, name in enumerate(("src_ip", "src_port", "dst_ip", "dst_port"))
                ]
            ),
        ).otherwise(F.struct(*[F.lit(None).cast("string").alias(n) for n in ("src_ip", "src_port", "dst_ip", "dst_port")]))
        short = F.from_json(
            F.to_json(
                F.struct(*[F.regexp_extract(body, AUDIT_SHORT, i + 1).alias(k) for i, k in enumerate(AUDIT_SHORT_KEYS)])
            ),
            "map<string,variant>",
        )
        long = F.from_json(
            F.to_json(
                F.struct(
                    *[
                        (ssh if k == "ssh" else F.regexp_extract(body, AUDIT_LONG, i + 1)).alias(k)
                        for i, k in enumerate(AUDIT_LONG_KEYS)
                    ]
                )
            ),
            "map<string,variant>",
        )
        extra = (
            F.when(F.col("__short"), short)
            .when(F.col("__long"), long)
            .otherwise(F.expr("cast(map() as map<string,variant>)"))
        )
        stream = F.when(audit, "snoopy").otherwise("linux")
        merged = F.map_concat(head, message, extra)
    else:
        kept = F.map_filter("__o", lambda k, v: ~k.isin(*RENAMED))
        new_keys = [name for name in RENAMED.values() if name != "@timestamp"]
        clash = F.arrays_overlap(F.map_keys(kept), F.array(*[F.lit(k) for k in new_keys]))
        clash = clash | (has("message") & has("syslog_message"))
        if family == "windows":
            error = error.when(program.isNull(), F.lit("missing key"))
            stream = F.when(F.contains(program, F.lit("sysmon")), "sysmon").otherwise("windows")
        else:
            event_type = F.expr(
                f"CASE WHEN schema_of_variant({_pick('__o', 'event_type')}) = 'STRING' "
                f"THEN lower(cast({_pick('__o', 'event_type')} as string)) END"
            )
            error = error.when(event_type.isNull(), F.lit("missing key"))
            stream = (
                F.when(F.contains(event_type, F.lit("alert")), "alert")
                .when(F.contains(event_type, F.lit("stats")), "stats")
                .when(F.contains(event_type, F.lit("flow")), "flow")
                .otherwise("protocols")
            )
        error = error.when(clash, F.lit("key collision"))
        merged = F.map_concat(kept, head, message)

    out = with_fields(out, [error.alias("_error")])
    good = F.col("_error").isNull()
    return out.select(
        *[c for c in df.columns if c != col],
        F.when(good, stream).alias("stream"),
        F.when(good, F.to_json(merged)).otherwise(F.col(col)).alias(col),
        "_error",
    )


def write_streams(df: DataFrame, path: str) -> None:
    """One gzip text folder per stream. Big streams are split over several files by AQE."""
    good = df.filter(F.col("_error").isNull()).select("stream", F.col("value"))
    good.hint("rebalance", "stream").write.partitionBy("stream").option("compression", "gzip").text(path)


def line_counts(df: DataFrame) -> DataFrame:
    """ok / bad counts, as the job reports them."""
    return df.agg(
        F.count_if(F.col("_error").isNull()).alias("ok"), F.count_if(F.col("_error").isNotNull()).alias("bad")
    )
