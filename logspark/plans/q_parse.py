"""Queries of the parse and normalise jobs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from logspark.functions.dynamic import dot_field, dot_text, parse_object
from logspark.functions.ip import canon_ip, cidr_address
from logspark.functions.times import offset_text, rfc3339_text
from logspark.operators import audit, cef, decode as dec, fields, normalize, reformat as ref, syslog
from logspark.plans import render
from logspark.plans.catalog import (
    EV,
    EVE_ALERT,
    EVE_TECH,
    FACILITY_SQL,
    PRI,
    SEVERITY_SQL,
    TECH_ID,
    query,
)
from logspark.plans.render import text
from logspark.sources.topics import parse_topic_map, with_kind

BAD_LINE = "(kind IN ('windows','sysmon') OR (kind IN ('syslog','suricata') AND k%10=9))"
APP = (
    "CASE WHEN kind='snoopy' THEN 'snoopy' WHEN kind='suricata' THEN 'suricata' WHEN k%20=13 THEN 'CEF' "
    "WHEN k%7=0 THEN '' ELSE 'app'||(k%5) END"
)
HOST = "CASE WHEN kind='syslog' AND k%20=13 THEN CASE WHEN k%40=33 THEN 'Mendel' ELSE 'MazeRunner' END ELSE host END"
CEF_TEXT = (
    "'CEF: 0|Vendor|Product|1.0|'||k||'|Decoy hit|'||(k%10)||'|src='||kip||' dst='||uip||' msg=decoy '||k||"
    "' touched dvchost='||host||' empty= end='"
)
SYSLOG_TEXT = (
    f"CASE WHEN k%20=13 THEN {CEF_TEXT} WHEN k%20=3 THEN '@cee: {{\"Hostname\":\"'||host||'\"}}' "
    "ELSE 'event '||event_id||' value '||k END"
)


def _lines(spark: SparkSession, sf: str, *kinds: str) -> DataFrame:
    rows = render.raw_lines(spark, sf)
    return rows.filter(F.col("topic").isin(*[f"raw-{k}" for k in kinds])) if kinds else rows


def _json(spark: SparkSession, sf: str, broken: bool = False) -> DataFrame:
    return dec.decode(render.json_events(spark, sf, broken))


@query(
    "n1_rfc5424",
    EV + f"""SELECT event_id, CASE WHEN NOT bad THEN {HOST} END AS host, CASE WHEN NOT bad THEN {APP} END AS program,
      CASE WHEN NOT bad THEN list_extract({SEVERITY_SQL}, {PRI}%8+1) END AS severity,
      CASE WHEN NOT bad THEN list_extract({FACILITY_SQL}, {PRI}//8+1) END AS facility,
      CASE WHEN NOT bad THEN epoch_us(ts) END AS ts_us,
      CASE WHEN NOT bad AND kind='syslog' THEN {SYSLOG_TEXT} END AS message, bad AS rejected
    FROM (SELECT *, {BAD_LINE} AS bad FROM ev)""",
)
def n1(spark, sf):
    p = syslog.parse_rfc5424(_lines(spark, sf))
    return p.select(
        F.col("offset").alias("event_id"), F.col("syslog_host").alias("host"), F.col("syslog_program").alias("program"),
        F.col("syslog_severity").alias("severity"), F.col("syslog_facility").alias("facility"),
        F.unix_micros("event_time").alias("ts_us"),
        F.when(F.col("topic") == "raw-syslog", F.col("syslog_message")).alias("message"),
        F.col("_error").isNotNull().alias("rejected"),
    )


@query(
    "n2_cee",
    EV + """SELECT event_id, k%20=3 AND k%10<>9 AS cee,
      CASE WHEN k%20=3 THEN '{"Hostname":"'||host||'"}' END AS payload FROM ev WHERE kind='syslog'""",
)
def n2(spark, sf):
    p = syslog.parse_rfc5424(_lines(spark, sf, "syslog"))
    message = F.col("syslog_message")
    return p.select(
        F.col("offset").alias("event_id"), F.coalesce(syslog.is_cee(message), F.lit(False)).alias("cee"),
        syslog.cee_payload(message).alias("payload"),
    )


@query(
    "n3_snoopy",
    EV + """SELECT event_id, CASE WHEN ok THEN ' cmd'||(k%10)||' -a '||event_id END AS cmd,
      CASE WHEN ok THEN '/bin/cmd'||(k%10) END AS filename, CASE WHEN ok THEN '/root' END AS cwd,
      CASE WHEN ok THEN CASE WHEN k%2=0 THEN '(none' ELSE 'none' END END AS tty, CASE WHEN ok THEN CAST(k AS VARCHAR) END AS sid,
      CASE WHEN ok THEN CASE WHEN k%2=0 THEN '0' ELSE '' END END AS gid,
      CASE WHEN ok THEN CASE WHEN k%2=0 THEN 'domain_users' ELSE '' END END AS grp, CASE WHEN ok THEN '0' END AS uid,
      CASE WHEN ok THEN CASE WHEN k%2=0 THEN 'root' ELSE '' END END AS username,
      CASE WHEN ok THEN CASE WHEN k%2=0 THEN 'user'||uid ELSE '' END END AS login,
      CASE WHEN k%2=0 AND k%4<>0 THEN kip||'|'||(k+1000)||'|'||uip||'|22' END AS ssh, NOT ok AS rejected
    FROM (SELECT *, k%10<>9 AS ok FROM ev WHERE kind='snoopy')""",
)
def n3(spark, sf):
    p = syslog.parse_rfc5424(_lines(spark, sf, "snoopy")).drop("_error")
    a = audit.parse_snoopy(p)
    ssh = F.when(F.col("ssh").isNotNull(), F.concat_ws("|", "ssh.src_ip", "ssh.src_port", "ssh.dst_ip", "ssh.dst_port"))
    return a.select(
        F.col("offset").alias("event_id"), "cmd", "filename", "cwd", "tty", "sid", "gid", F.col("group").alias("grp"),
        "uid", "username", "login", ssh.alias("ssh"), F.col("_error").isNotNull().alias("rejected"),
    )


@query(
    "n4_cef",
    EV + """SELECT event_id, CASE WHEN c THEN 'Vendor' END AS vendor, CASE WHEN c THEN CAST(k AS VARCHAR) END AS signature,
      CASE WHEN c THEN 'Decoy hit' END AS name, CASE WHEN c THEN CAST(k%10 AS VARCHAR) END AS severity,
      CASE WHEN c THEN kip END AS ext_src, CASE WHEN c THEN 'decoy '||k||' touched' END AS ext_msg,
      CASE WHEN c THEN '' END AS ext_empty, CASE WHEN c THEN CAST(5 AS BIGINT) END AS n_ext, NOT c AS rejected
    FROM (SELECT *, k%20=13 AS c FROM ev WHERE kind='syslog' AND k%10<>9)""",
)
def n4(spark, sf):
    p = syslog.parse_rfc5424(_lines(spark, sf, "syslog")).filter(F.col("_error").isNull()).drop("_error")
    c = cef.parse_cef(p)
    e = F.col("Extensions")
    return c.select(
        F.col("offset").alias("event_id"), F.col("DeviceVendor").alias("vendor"), F.col("SignatureID").alias("signature"),
        F.col("Name").alias("name"), F.col("Severity").alias("severity"), F.try_element_at(e, F.lit("src")).alias("ext_src"),
        F.try_element_at(e, F.lit("msg")).alias("ext_msg"), F.try_element_at(e, F.lit("empty")).alias("ext_empty"),
        F.size(e).cast("bigint").alias("n_ext"), F.col("_error").isNotNull().alias("rejected"),
    )


@query(
    "n5_dispatch",
    EV + f"""SELECT event_id,
      CASE WHEN kind='syslog' AND k%10=9 THEN NULL WHEN kind='snoopy' THEN 'snoopy' WHEN k%20=3 THEN 'cee_windows'
        WHEN k%20=13 THEN 'cef' ELSE 'syslog' END AS payload_type,
      k%10<>9 AND (kind='snoopy' OR k%20 NOT IN (3,13)) AS kept,
      CASE WHEN k%10<>9 AND (kind='snoopy' OR k%20 NOT IN (3,13)) THEN host END AS host,
      CASE WHEN k%10<>9 THEN CASE WHEN kind='snoopy' THEN ' cmd'||(k%10)||' -a '||event_id
        WHEN k%20 NOT IN (3,13) THEN {SYSLOG_TEXT} END END AS body
    FROM ev WHERE kind IN ('syslog','snoopy')""",
)
def n5(spark, sf):
    p = normalize.normalize_syslog(_lines(spark, sf, "syslog", "snoopy"))
    body = F.when(F.col("payload_type") == "snoopy", F.get_json_object("json", "$.cmd")).otherwise(
        F.get_json_object("json", "$.syslog_message")
    )
    return p.select(
        F.col("offset").alias("event_id"), "payload_type", F.col("_error").isNull().alias("kept"),
        F.get_json_object("json", "$.syslog_host").alias("host"), body.alias("body"),
    )


@query(
    "n5_dispatch_keep",
    EV + """SELECT event_id, k%20=13 AS is_cef, CASE WHEN k%20=13 THEN 'Vendor' END AS vendor,
      CASE WHEN k%20=3 THEN host END AS cee_host FROM ev WHERE kind='syslog' AND k%10<>9""",
)
def n5_keep(spark, sf):
    p = normalize.normalize_syslog(_lines(spark, sf, "syslog"), keep=("cef", "cee_windows", "cee_suricata"))
    p = p.filter(F.col("_error").isNull())
    return p.select(
        F.col("offset").alias("event_id"), (F.col("payload_type") == "cef").alias("is_cef"),
        F.get_json_object("json", "$.cef.DeviceVendor").alias("vendor"),
        F.get_json_object("json", "$.Hostname").alias("cee_host"),
    )


@query(
    "n6_unwrap",
    EV + """SELECT event_id, CASE WHEN k%10<>9 THEN uip END AS src_ip, CASE WHEN k%10<>9 AND k%5<>0 THEN k+2000 END AS sid,
      k%10=9 AS rejected FROM ev WHERE kind='suricata'""",
)
def n6(spark, sf):
    p = normalize.unwrap_suricata(_lines(spark, sf, "suricata"))
    return p.select(
        F.col("offset").alias("event_id"), F.get_json_object("json", "$.src_ip").alias("src_ip"),
        F.get_json_object("json", "$.alert.signature_id").cast("bigint").alias("sid"),
        F.col("_error").isNotNull().alias("rejected"),
    )


@query(
    "n7_preprocess",
    EV + """SELECT event_id, kind AS source_kind, CASE WHEN ok THEN kind END AS kind, CASE WHEN ok THEN host END AS host,
      CASE WHEN kind='syslog' AND ok THEN CAST(epoch_us(ts) AS BIGINT) END AS ts_us, NOT ok AS rejected
    FROM (SELECT *, kind='windows' OR (k%10<>9 AND (kind<>'syslog' OR k%20 NOT IN (3,13))) AS ok
          FROM ev WHERE kind<>'sysmon')""",
)
def n7(spark, sf):
    rows = with_kind(render.raw_lines(spark, sf), parse_topic_map(render.TOPIC_MAP)).drop("_error")
    p = normalize.preprocess(rows)
    good = F.col("_error").isNull()
    host = F.coalesce(
        F.get_json_object("value", "$.syslog_host"), F.get_json_object("value", "$.host"),
        F.get_json_object("value", "$.winlog.computer_name"),
    )
    stamp = F.get_json_object("value", "$.@timestamp").try_cast("timestamp")
    return p.select(
        F.col("offset").alias("event_id"), "source_kind", "kind", F.when(good, host).alias("host"),
        F.when(good & (F.col("kind") == "syslog"), F.unix_micros(stamp)).alias("ts_us"), (~good).alias("rejected"),
    )


@query(
    "n7_preprocess_counts",
    EV + """SELECT kind AS source_kind, count(*) AS lines,
      CAST(sum(CASE WHEN kind='windows' OR (k%10<>9 AND (kind<>'syslog' OR k%20 NOT IN (3,13))) THEN 1 ELSE 0 END) AS BIGINT) AS produced
    FROM ev WHERE kind<>'sysmon' GROUP BY 1""",
)
def n7_counts(spark, sf):
    rows = with_kind(render.raw_lines(spark, sf), parse_topic_map(render.TOPIC_MAP)).drop("_error")
    p = normalize.preprocess(rows)
    return p.groupBy("source_kind").agg(
        F.count(F.lit(1)).alias("lines"), F.count_if(F.col("_error").isNull()).alias("produced")
    )


@query(
    "n8_repair",
    EV + """SELECT event_id, k%25=24 OR k%10=9 AS broken, k%25<>24 AND k%10=9 AS fixed, k%25=24 AS rejected,
      CASE WHEN k%25<>24 THEN CASE WHEN k%10=9 THEN '(x) *' ELSE 'plain' END END AS note FROM ev""",
)
def n8(spark, sf):
    p = dec.repair_json(render.time_lines(spark, sf))
    return p.select(
        "event_id", "broken", "fixed", F.col("_error").isNotNull().alias("rejected"),
        F.when(F.col("_error").isNull(), F.get_json_object("value", "$.note")).alias("note"),
    )


def _stamps(spark, sf):
    ev = render.base_events(spark, sf)
    k = F.col("k")
    sec = F.date_trunc("second", "ts")
    plain = lambda hours: F.date_format(sec + F.expr(f"INTERVAL {hours} HOURS"), "yyyy-MM-dd HH:mm:ss")
    fields_ = F.struct(
        F.when(k % 13 != 0, rfc3339_text(F.col("ts"))).alias("@timestamp"),
        F.when(k % 3 == 0, offset_text(F.col("ts") + F.expr("INTERVAL 1 HOUR"))).alias("timestamp"),
        F.when(k % 16 == 1, F.lit("yesterday")).when(k % 4 == 0, plain(2)).alias("EventTime"),
        F.when(k % 8 == 0, plain(3)).alias("EventReceivedTime"),
    )
    return ev.select("event_id", F.to_json(fields_).alias("value"))


_KNOWN = """CASE WHEN k%16=1 THEN NULL WHEN k%8=0 THEN epoch_us(date_trunc('second', ts) + INTERVAL 3 HOUR)
  WHEN k%4=0 THEN epoch_us(date_trunc('second', ts) + INTERVAL 2 HOUR) WHEN k%3=0 THEN epoch_us(ts + INTERVAL 1 HOUR)
  WHEN k%13<>0 THEN epoch_us(ts) END"""


@query(
    "n9_known_time",
    EV + f"""SELECT event_id, {_KNOWN} AS known_us, CASE WHEN k%16<>1 AND k%13<>0 THEN epoch_us(ts) END AS syslog_us,
      k%16=1 AS rejected FROM ev""",
)
def n9(spark, sf):
    one = dec.known_time(_stamps(spark, sf)).withColumnRenamed("known_time", "a").drop("_error")
    both = dec.known_time(one, prefer_syslog=True)
    return both.select(
        "event_id", F.unix_micros("a").alias("known_us"), F.unix_micros("known_time").alias("syslog_us"),
        F.col("_error").isNotNull().alias("rejected"),
    )


@query(
    "n10_dot_field",
    EV + f"""SELECT event_id, CASE WHEN {EVE_ALERT} THEN 'Category '||(k%4) END AS category,
      CASE WHEN kind IN ('windows','sysmon') THEN 'user'||uid END AS user_name,
      CASE WHEN kind='suricata' THEN host END AS host_name,
      CASE WHEN kind='windows' THEN CAST(k+4600 AS VARCHAR)
        WHEN kind='sysmon' THEN CASE k%4 WHEN 0 THEN '1' WHEN 1 THEN '3' WHEN 2 THEN '5' ELSE '1' END END AS eid FROM ev""",
)
def n10(spark, sf):
    rows = render.json_events(spark, sf).withColumn("v", parse_object("value"))
    return rows.select(
        F.col("offset").alias("event_id"), dot_text("v", "alert.category").alias("category"),
        dot_text("v", "winlog.user.name").alias("user_name"), dot_text("v", "host.name").alias("host_name"),
        dot_text("v", "winlog.event_id").alias("eid"),
    )


@query(
    "n10_dot_value",
    EV + f"""SELECT event_id, CASE WHEN {EVE_ALERT} THEN CAST(2000+k AS BIGINT) END AS sid, CASE WHEN {EVE_TECH} THEN 'ARRAY<STRING>' END AS kind_of,
      CASE WHEN {EVE_TECH} THEN '["'||{TECH_ID}||'"]' END AS ids, CASE WHEN kind='suricata' THEN host END AS under FROM ev""",
)
def n10_value(spark, sf):
    """The value itself, with its type: a number, an array, and what stands where a path goes on below a text."""
    rows = render.json_events(spark, sf).withColumn("v", parse_object("value"))
    ids = dot_field("v", "alert.metadata.mitre_technique_id")
    listed = F.schema_of_variant(ids).startswith("ARRAY")
    return rows.select(
        F.col("offset").alias("event_id"), F.try_variant_get(dot_field("v", "alert.signature_id"), "$", "bigint").alias("sid"),
        F.when(listed, F.schema_of_variant(ids)).alias("kind_of"), F.when(listed, F.to_json(ids)).alias("ids"),
        F.try_variant_get(dot_field("v", "host.name"), "$", "string").alias("under"),
    )


@query(
    "n11_decode",
    EV + """SELECT kind, count(*) AS events, CAST(sum(CASE WHEN k%10=9 THEN 1 ELSE 0 END) AS BIGINT) AS errors,
      CAST(sum(CASE WHEN k%10<>9 AND kind='suricata' AND k%13=0 THEN 1 ELSE 0 END) AS BIGINT) AS missing_time FROM ev GROUP BY 1""",
)
def n11(spark, sf):
    d = _json(spark, sf, broken=True)
    no_time = F.col("_error").isNull() & (F.col("kind") == "suricata") & fields.event_time().isNull()
    return d.groupBy("kind").agg(
        F.count(F.lit(1)).alias("events"), F.count_if(F.col("_error").isNotNull()).alias("errors"),
        F.count_if(no_time).alias("missing_time"),
    )


@query(
    "n12_event_time",
    EV + "SELECT event_id, CASE WHEN NOT (kind='suricata' AND k%13=0) THEN epoch_us(ts) END AS ts_us FROM ev",
)
def n12(spark, sf):
    return _json(spark, sf).select(F.col("offset").alias("event_id"), F.unix_micros(fields.event_time()).alias("ts_us"))


def _legacy(spark, sf):
    """Flat Windows records: Sysmon ones count from receipt."""
    ev = render.base_events(spark, sf)
    k = F.col("k")
    plain = lambda h: F.date_format(F.col("ts") + F.expr(f"INTERVAL {h} HOURS"), "yyyy-MM-dd HH:mm:ss")
    o = F.struct(
        F.when(k % 3 == 0, F.lit("Microsoft-Windows-Sysmon")).when(k % 3 == 1, F.lit("Security")).alias("SourceName"),
        F.lit("eventlog").alias("syslog_program"),
        F.when(k % 2 == 0, F.col("host")).alias("Hostname"),
        F.lit("relay").alias("syslog_host"),
        F.col("uip").alias("syslog_ip"),
        plain(0).alias("EventTime"),
        plain(1).alias("EventReceivedTime"),
    )
    return ev.select("event_id", F.to_json(o).alias("value")).withColumn("v", parse_object("value"))


@query(
    "n12_legacy_windows",
    EV + """SELECT event_id, epoch_us(date_trunc('second', ts) + CASE WHEN k%3=0 THEN INTERVAL 1 HOUR ELSE INTERVAL 0 HOUR END) AS ts_us,
      CASE k%3 WHEN 0 THEN 'Microsoft-Windows-Sysmon' WHEN 1 THEN 'Security' ELSE 'eventlog' END AS source,
      CASE WHEN k%2=0 THEN host ELSE 'relay' END AS sender, uip AS sender_ip FROM ev""",
)
def n12_legacy(spark, sf):
    return _legacy(spark, sf).select(
        "event_id", F.unix_micros(fields.legacy_time()).alias("ts_us"), fields.legacy_source().alias("source"),
        fields.legacy_sender().alias("sender"), fields.legacy_sender_ip().alias("sender_ip"),
    )


@query(
    "n13_origin",
    EV + """SELECT event_id, CASE kind WHEN 'suricata' THEN CASE WHEN k%5=0 THEN 'flow' ELSE 'alert' END WHEN 'windows' THEN 'Security'
      WHEN 'sysmon' THEN 'Microsoft-Windows-Sysmon/Operational' WHEN 'syslog' THEN 'app'||(k%5) ELSE 'root' END AS source,
      host AS sender FROM ev""",
)
def n13(spark, sf):
    return _json(spark, sf).select(
        F.col("offset").alias("event_id"), fields.source().alias("source"), fields.sender().alias("sender")
    )


@query(
    "n13_honeypot_origin",
    EV + "SELECT event_id, 'Product' AS source, host AS sender FROM ev WHERE kind='syslog' AND k%20=13",
)
def n13_honeypot(spark, sf):
    p = syslog.parse_rfc5424(_lines(spark, sf, "syslog")).drop("_error")
    c = cef.parse_cef(p).filter(F.col("_error").isNull())
    return c.select(
        F.col("offset").alias("event_id"), fields.honeypot_source().alias("source"), fields.honeypot_sender().alias("sender")
    )


@query(
    "n13_cef_origin",
    EV + "SELECT event_id, 'Product' AS source, 'Vendor' AS sender FROM ev WHERE kind='syslog' AND k%20=13",
)
def n13_cef(spark, sf):
    c = cef.parse_cef(syslog.parse_rfc5424(_lines(spark, sf, "syslog")).drop("_error")).filter(F.col("_error").isNull())
    return c.select(F.col("offset").alias("event_id"), fields.cef_source().alias("source"), fields.cef_sender().alias("sender"))


@query(
    "n14_select",
    EV + f"""SELECT event_id, CASE WHEN kind IN ('syslog','snoopy','suricata') THEN host END AS host,
      CASE WHEN kind='syslog' THEN 'event '||event_id||' value '||k WHEN kind='snoopy' THEN ''
        WHEN kind IN ('windows','sysmon') AND k%6<>0 THEN 'win msg '||k END AS message,
      CASE WHEN kind='snoopy' THEN ' cmd'||(k%10)||' -a '||event_id END AS cmd,
      CASE WHEN kind='snoopy' AND k%2=0 AND k%4<>0 THEN kip END AS ssh_src,
      CASE WHEN {EVE_ALERT} THEN CAST(2000+k AS VARCHAR) END AS sid FROM ev""",
)
def n14(spark, sf):
    return _json(spark, sf).select(
        F.col("offset").alias("event_id"), fields.select_field("host").alias("host"),
        fields.select_field("message").alias("message"), fields.select_field("cmd").alias("cmd"),
        fields.select_field("ssh.src_ip").alias("ssh_src"), fields.select_field("alert.signature_id").alias("sid"),
    )


@query(
    "n15_keywords",
    EV + """SELECT event_id, CASE WHEN kind='syslog' THEN 'event '||event_id||' value '||k
      WHEN kind='snoopy' THEN ' cmd'||(k%10)||' -a '||event_id
      WHEN kind='suricata' THEN CASE WHEN k%5<>0 AND k%4=0 THEN 'Category '||(k%4)||'|GET /'||k WHEN k%5<>0 THEN 'Category '||(k%4)
        WHEN k%4=0 THEN 'GET /'||k END
      WHEN k%6<>0 THEN 'win msg '||k END AS words FROM ev""",
)
def n15(spark, sf):
    return _json(spark, sf).select(
        F.col("offset").alias("event_id"), F.array_join(fields.keywords(), "|").alias("words")
    )


@query(
    "n16_digest",
    EV + """SELECT event_id, CASE WHEN kind='suricata' AND k%5<>0 THEN 2000+k WHEN kind='windows' THEN 4600+k
        WHEN kind='sysmon' AND k%4=3 THEN 1 ELSE 0 END AS id,
      CASE kind WHEN 'suricata' THEN CASE WHEN k%5=0 THEN 'flow' ELSE 'alert' END WHEN 'windows' THEN 'Security'
        WHEN 'sysmon' THEN 'Microsoft-Windows-Sysmon/Operational' WHEN 'syslog' THEN 'app'||(k%5) ELSE '/bin/cmd'||(k%10) END AS key,
      CASE kind WHEN 'suricata' THEN CASE WHEN k%5=0 THEN '' ELSE 'Category '||(k%4) END
        WHEN 'syslog' THEN 'event '||event_id||' value '||k WHEN 'snoopy' THEN ' cmd'||(k%10)||' -a '||event_id||'|/root|root'
        ELSE 'proc'||(k%8)||'.exe|'||CASE WHEN k%2=0 THEN 'C:/img'||(k%3)||'.exe|' ELSE '' END||'Task '||(k%6)||'|user'||uid END AS fields
    FROM ev""",
)
def n16(spark, sf):
    d = _json(spark, sf).withColumn("d", fields.event_data())
    return d.select(
        F.col("offset").alias("event_id"), F.col("d.ID").alias("id"), F.col("d.Key").alias("key"),
        F.array_join("d.Fields", "|").alias("fields"),
    )


@query(
    "n17_canon_ip",
    EV + """SELECT event_id, uip AS v4, CASE WHEN uid%65536=0 THEN 'fd00::' ELSE 'fd00::'||format('{:x}', uid%65536) END AS v6,
      uip AS mapped, CAST(NULL AS VARCHAR) AS bad, kip AS cidr FROM ev""",
)
def n17(spark, sf):
    ev = render.base_events(spark, sf)
    v6 = F.concat(F.lit("FD00:0000:0:0:0::"), F.lpad(F.hex(F.col("uid") % 65536), 4, "0"))
    return ev.select(
        "event_id", canon_ip(F.col("uip")).alias("v4"), canon_ip(v6).alias("v6"),
        canon_ip(F.concat(F.lit("::ffff:"), F.col("uip"))).alias("mapped"),
        canon_ip(F.concat(F.lit("0"), F.col("uip"))).alias("bad"),
        cidr_address(F.concat(F.col("kip"), F.lit("/24"))).alias("cidr"),
    )


@query(
    "n18_suricata_ts",
    EV + "SELECT event_id, strftime(ts, '%Y-%m-%dT%H:%M:%S.%f+0000') AS offset_form, strftime(ts, '%Y-%m-%dT%H:%M:%S.%f+0000') AS zulu_form FROM ev",
)
def n18(spark, sf):
    ev = render.base_events(spark, sf)
    return ev.select(
        "event_id", dec.suricata_ts(offset_text(F.col("ts"))).alias("offset_form"),
        dec.suricata_ts(rfc3339_text(F.col("ts"))).alias("zulu_form"),
    )


@query(
    "n19_is_alert",
    EV + f"SELECT kind, {EVE_ALERT} AS alert, count(*) AS n FROM ev GROUP BY 1, 2",
)
def n19(spark, sf):
    rows = render.json_events(spark, sf)
    return rows.groupBy("kind", dec.is_alert(F.col("value")).alias("alert")).agg(F.count(F.lit(1)).alias("n"))


@query(
    "n20_zeek_notes",
    EV + """SELECT event_id, 'C'||event_id AS uid, uip AS orig_h, k AS orig_p, kip AS resp_h, 'Note::'||(k%5) AS note, 'a,b' AS actions,
      CAST(floor(epoch_us(ts)/1000000.0) AS BIGINT) AS ts_s, k%2=0 AS dropped, uip AS source, 'cobalt' AS sender FROM ev""",
)
def n20(spark, sf):
    ev = render.base_events(spark, sf)
    note = F.struct(
        (F.unix_micros("ts") / 1_000_000).alias("ts"), F.concat(F.lit("C"), text(F.col("event_id"))).alias("uid"),
        F.col("uip").alias("id.orig_h"), F.col("k").alias("id.orig_p"), F.col("kip").alias("id.resp_h"),
        F.lit(443).alias("id.resp_p"), F.lit("tcp").alias("proto"), F.concat(F.lit("Note::"), text(F.col("k") % 5)).alias("note"),
        F.lit("m").alias("msg"), F.lit("s").alias("sub"), F.col("uip").alias("src"), F.col("kip").alias("dst"),
        F.lit(443).alias("p"), F.array(F.lit("a"), F.lit("b")).alias("actions"), F.lit(1.5).alias("suppress_for"),
        (F.col("k") % 2 == 0).alias("dropped"),
    )
    z = dec.parse_zeek_notes(ev.select("event_id", F.to_json(note).alias("value")))
    return z.select(
        "event_id", "uid", F.col("`id.orig_h`").alias("orig_h"), F.col("`id.orig_p`").cast("bigint").alias("orig_p"),
        F.col("`id.resp_h`").alias("resp_h"), "note", F.array_join("actions", ",").alias("actions"),
        F.unix_seconds("event_time").alias("ts_s"), "dropped", "source", "sender",
    )


@query(
    "n21_cef_endpoints",
    EV + "SELECT event_id, kip AS src_ip, uip AS dst_ip FROM ev WHERE kind='syslog' AND k%20=13",
)
def n21(spark, sf):
    p = syslog.parse_rfc5424(_lines(spark, sf, "syslog")).drop("_error")
    c = cef.cef_endpoints(cef.parse_cef(p).filter(F.col("_error").isNull()))
    return c.select(F.col("offset").alias("event_id"), "src_ip", "dst_ip")


@query(
    "n22_bsd_syslog",
    EV + """SELECT event_id, CASE WHEN k%10=9 THEN NULL WHEN k%3=0 THEN '1' ELSE CAST(k AS VARCHAR) END AS pri,
      CASE WHEN k%10<>9 THEN host END AS host, CASE WHEN k%10=9 THEN NULL WHEN k%2=0 THEN '666' ELSE CAST(event_id AS VARCHAR) END AS pid,
      CASE WHEN k%10<>9 THEN '<'||CASE WHEN k%3=0 THEN '1' ELSE CAST(k AS VARCHAR) END||'>'||strftime(ts, '%Y-%m-%dT%H:%M:%S.%fZ')||' '||host||' prog['
        ||CASE WHEN k%2=0 THEN '666' ELSE CAST(event_id AS VARCHAR) END||']: text '||k END AS line, k%10=9 AS rejected FROM ev""",
)
def n22(spark, sf):
    ev = render.base_events(spark, sf)
    k = F.col("k")
    value = F.when(k % 10 == 9, F.lit("oneword")).otherwise(
        F.concat(
            F.when(k % 3 != 0, F.concat(F.lit("<"), text(k), F.lit(">"))).otherwise(F.lit("")), rfc3339_text(F.col("ts")),
            F.lit(" "), F.col("host"), F.lit(" prog"),
            F.when(k % 2 != 0, F.concat(F.lit("["), text(F.col("event_id")), F.lit("]"))).otherwise(F.lit("")),
            F.lit(": text "), text(k), F.lit("  "),
        )
    )
    b = syslog.parse_bsd_syslog(ev.select("event_id", value.alias("value")))
    return b.select("event_id", "pri", "host", "pid", "line", F.col("_error").isNotNull().alias("rejected"))


def _short_keys(ev: DataFrame, *extra) -> DataFrame:
    head = [
        rfc3339_text(F.col("ts")).alias("@timestamp"), F.col("host"), F.col("program"), F.lit("info").alias("severity"),
        F.lit("user").alias("facility"), F.col("uip").alias("ip"),
    ]
    return ev.select("event_id", F.to_json(F.struct(*head, *extra)).alias("value"))


@query(
    "n23_reformat_linux",
    EV + """SELECT event_id, CASE WHEN kind='snoopy' THEN 'snoopy' ELSE 'linux' END AS stream, host AS syslog_host,
      CASE WHEN kind='snoopy' THEN CASE WHEN k%10<>9 AND (k%2=1 OR k%4<>0) THEN 'cmd'||(k%10)||' -a '||event_id
        WHEN k%10<>9 THEN 'cmd'||(k%10)||' -a '||event_id END END AS cmd,
      CASE WHEN kind='snoopy' AND k%2=0 AND k%4<>0 THEN kip END AS ssh_src, false AS rejected
    FROM ev WHERE kind IN ('syslog','snoopy')""",
)
def n23_linux(spark, sf):
    ev = render.base_events(spark, sf).filter(F.col("kind").isin("syslog", "snoopy"))
    # the second pattern has no blank in a group name
    message = F.when(F.col("kind") == "snoopy", F.replace(render.audit_message(), F.lit("domain users"), F.lit("users"))).otherwise("plain")
    ev = ev.withColumn("program", F.when(F.col("kind") == "snoopy", "Snoopy").otherwise("sshd"))
    r = ref.reformat(_short_keys(ev, message.alias("message")), "linux")
    return r.select(
        "event_id", "stream", F.get_json_object("value", "$.syslog_host").alias("syslog_host"),
        F.get_json_object("value", "$.cmd").alias("cmd"), F.get_json_object("value", "$.ssh.src_ip").alias("ssh_src"),
        F.col("_error").isNotNull().alias("rejected"),
    )


@query(
    "n23_reformat_windows",
    EV + """SELECT event_id, CASE WHEN k%9=8 THEN NULL WHEN kind='sysmon' THEN 'sysmon' ELSE 'windows' END AS stream,
      CASE WHEN k%9<>8 THEN host END AS syslog_host, CASE WHEN k%9<>8 THEN 'win "'||k||'"' END AS message,
      CASE WHEN k%9<>8 THEN 'win "'||k||'"' END AS syslog_message, CASE WHEN k%9<>8 THEN k END AS extra, k%9=8 AS rejected
    FROM ev WHERE kind IN ('windows','sysmon')""",
)
def n23_windows(spark, sf):
    r = _windows_streams(spark, sf)
    good = F.col("_error").isNull()
    return r.select(
        "event_id", "stream",
        *[F.when(good, F.get_json_object("value", f"$.{n}")).alias(n) for n in ("syslog_host", "message", "syslog_message")],
        F.when(good, F.get_json_object("value", "$.extra").cast("bigint")).alias("extra"), (~good).alias("rejected"),
    )


def _windows_streams(spark, sf):
    ev = render.base_events(spark, sf).filter(F.col("kind").isin("windows", "sysmon"))
    ev = ev.withColumn("program", F.when(F.col("kind") == "sysmon", "Win-Sysmon").otherwise("eventlog"))
    message = F.concat(F.lit('win "'), text(F.col("k")), F.lit('"')).alias("message")
    clash = F.when(F.col("k") % 9 == 8, F.lit("x")).alias("syslog_ip")
    rows = _short_keys(ev, message, F.col("k").alias("extra"), clash)
    # as shipped, quotes inside arrive escaped twice
    rows = rows.withColumn("value", F.replace("value", F.lit('\\"'), F.lit('\\\\\\"')))
    return ref.reformat(rows, "windows")


@query(
    "n23_write_streams",
    EV + """, w AS (SELECT *, k%9=8 AS bad, CASE WHEN kind='sysmon' THEN 'sysmon' ELSE 'windows' END AS stream FROM ev WHERE kind IN ('windows','sysmon'))
    SELECT stream, count(*) AS n, CAST(sum(k) AS BIGINT) AS extra FROM w WHERE NOT bad GROUP BY 1
    UNION ALL SELECT 'ok', count(*), NULL FROM w WHERE NOT bad UNION ALL SELECT 'bad', count(*), NULL FROM w WHERE bad""",
)
def n23_written(spark, sf):
    """What the writer's folders hold, read back, and the counts that the job reports."""
    r = _windows_streams(spark, sf)
    path = render.scratch_path(spark, "streams")
    ref.write_streams(r, path)
    back = spark.read.schema("value STRING, stream STRING").text(path)
    extra = F.sum(F.get_json_object("value", "$.extra").cast("bigint"))
    streams = back.groupBy("stream").agg(F.count(F.lit(1)).alias("n"), extra.alias("extra"))
    counts = ref.line_counts(r).select(F.expr("stack(2, 'ok', ok, 'bad', bad) AS (stream, n)"), F.lit(None).cast("bigint").alias("extra"))
    return streams.unionByName(counts)


@query(
    "n23_reformat_suricata",
    EV + """SELECT CASE k%6 WHEN 0 THEN 'alert' WHEN 1 THEN 'stats' WHEN 2 THEN 'flow' WHEN 3 THEN 'flow' WHEN 4 THEN 'protocols' END AS stream,
      count(*) AS n, CAST(sum(CASE WHEN k%6=5 THEN 1 ELSE 0 END) AS BIGINT) AS rejected FROM ev WHERE kind='suricata' GROUP BY 1""",
)
def n23_suricata(spark, sf):
    ev = render.base_events(spark, sf).filter("kind = 'suricata'").withColumn("program", F.lit("suricata"))
    types = ("alert", "stats", "flow", "netflow", "dns")
    event_type = F.lit(None).cast("string")
    for i, name in enumerate(types):
        event_type = F.when(F.col("k") % 6 == i, name).otherwise(event_type)
    r = ref.reformat(_short_keys(ev, event_type.alias("event_type")), "suricata")
    return r.groupBy("stream").agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("_error").isNotNull()).alias("rejected"))


@query(
    "n24_fix_headers",
    EV + "SELECT event_id, '<'||k||'>1 '||strftime(ts, '%Y-%m-%dT%H:%M:%S.%fZ')||' collector imkafka '||host||' - text '||k AS value FROM ev",
)
def n24(spark, sf):
    ev = render.base_events(spark, sf)
    line = F.concat(
        F.lit("<"), text(F.col("k")), F.lit(">1 "), rfc3339_text(F.col("ts")), F.lit("   "), F.col("host"), F.lit(" - text "),
        text(F.col("k")),
    )
    return syslog.fix_headers(ev.select("event_id", line.alias("value")))


@query(
    "n25_sysmon",
    EV + "SELECT CASE k%4 WHEN 0 THEN '1' ELSE '3' END AS sysmon_id, count(*) AS events FROM ev WHERE kind='sysmon' AND k%4 IN (0,1) GROUP BY 1",
)
def n25(spark, sf):
    return dec.sysmon_counts(dec.sysmon_process_network(render.json_events(spark, sf)))


@query(
    "n25_sysmon_numeric",
    EV + "SELECT event_id, CASE WHEN k%4=1 THEN '3' ELSE '1' END AS sysmon_id FROM ev WHERE kind='sysmon' AND k%4 IN (0,1,3)",
)
def n25_numeric(spark, sf):
    rows = dec.sysmon_process_network(render.json_events(spark, sf), numeric_ids=True)
    return rows.select(F.col("offset").alias("event_id"), "sysmon_id")
