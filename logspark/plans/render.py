"""Log lines, JSON events and dimension files rendered from the given tables.

The tables hold no logs, so every registered query first prints its rows as log text, each row
from its own columns. Whatever the operators then read back can be compared with the columns the
text came from. All choices depend on ``k``, the integer in ``events.props``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from logspark.fixed import FACILITIES, SEVERITIES, SYSMON_CHANNEL
from logspark.functions.times import offset_text, rfc3339_text
from logspark.schemas import RECORD_COLUMNS
from logspark.session import configure, scratch_path

KIND_OF = {"click": "syslog", "view": "snoopy", "purchase": "suricata", "signup": "windows", "error": "sysmon"}
TOPIC_MAP = [f"raw-{kind}:{kind}" for kind in KIND_OF.values()]

LINES_PER_FILE = 2000
OBJECTS_PER_DOC = 1000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    configure(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text(col: Column) -> Column:
    return col.cast("string")


def int_div(a: Column, b: int) -> Column:
    return F.call_function("div", a.cast("bigint"), F.lit(b).cast("bigint"))


def ip_of(n: Column, first: str = "10") -> Column:
    """``first``.a.b.c of an integer's three low bytes."""
    return F.concat_ws(
        ".", F.lit(first), text(int_div(n, 65536) % 256), text(int_div(n, 256) % 256), text(n.cast("bigint") % 256)
    )


def technique_id(n: Column) -> Column:
    return F.concat(F.lit("T1"), F.lpad(text(n % 1000), 3, "0"))


def base_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """event_id, ts, uid, value, k, kind, host, uip, kip."""
    k = F.get_json_object("props", "$.k").cast("bigint")
    kind = F.col("event_type")
    for name, label in KIND_OF.items():
        kind = F.when(F.col("event_type") == name, label).otherwise(kind)
    return table(spark, sf_dir, "events").select(
        "event_id",
        F.col("ts").cast("timestamp").alias("ts"),
        F.col("user_id").alias("uid"),
        "value",
        k.alias("k"),
        kind.alias("kind"),
        F.concat(F.lit("host-"), text(F.col("user_id"))).alias("host"),
        ip_of(F.col("user_id")).alias("uip"),
        F.concat(F.lit("10.0.0."), text(k)).alias("kip"),
    )


def _k(m: int, r: int = 0) -> Column:
    return F.col("k") % m == r


def eve_json() -> Column:
    """Suricata event; alerts unless k%5=0, technique when k%3=0, no time when k%13=0."""
    alert = F.struct(
        (F.col("k") + 2000).alias("signature_id"),
        F.concat(F.lit("SIG "), text(F.col("k"))).alias("signature"),
        F.concat(F.lit("Category "), text(F.col("k") % 4)).alias("category"),
        F.when(_k(3), F.struct(F.array(technique_id(F.col("k"))).alias("mitre_technique_id"))).alias("metadata"),
    )
    return F.to_json(
        F.struct(
            F.when(~_k(13), rfc3339_text(F.col("ts"))).alias("@timestamp"),
            offset_text(F.col("ts")).alias("timestamp"),
            F.when(_k(5), "flow").otherwise("alert").alias("event_type"),
            F.col("host"),
            F.col("uip").alias("src_ip"),
            F.when(~_k(17), F.col("kip")).alias("dest_ip"),
            F.when(_k(4), F.concat(F.lit("GET /"), text(F.col("k")))).alias("payload_printable"),
            F.when(~_k(5), alert).alias("alert"),
        )
    )


def winlog_json() -> Column:
    """Windows event; sysmon ids are the strings 1, 3, 5 or the number 1, others are numbers."""
    k = F.col("k")
    sysmon = F.col("kind") == "sysmon"
    event_id = (
        F.when(sysmon & _k(4, 0), F.lit("1").cast("variant"))
        .when(sysmon & _k(4, 1), F.lit("3").cast("variant"))
        .when(sysmon & _k(4, 2), F.lit("5").cast("variant"))
        .when(sysmon, F.lit(1).cast("variant"))
        .otherwise((k + 4600).cast("variant"))
    )
    rule = F.when(_k(11), F.lit("a=b,c=d,e=f")).when(
        _k(3), F.concat(F.lit("technique_id="), F.lower(technique_id(k)), F.lit(",technique_name=Tech "), text(k))
    )
    winlog = F.struct(
        F.when(sysmon, SYSMON_CHANNEL).otherwise("Security").alias("channel"),
        F.col("host").alias("computer_name"),
        event_id.alias("event_id"),
        F.concat(F.lit("Task "), text(k % 6)).alias("task"),
        F.struct(F.concat(F.lit("user"), text(F.col("uid"))).alias("name")).alias("user"),
        F.when(_k(2), F.struct(F.concat(F.lit("C:/img"), text(k % 3), F.lit(".exe")).alias("TargetImage"))).alias(
            "event_data"
        ),
    )
    return F.to_json(
        F.struct(
            rfc3339_text(F.col("ts")).alias("@timestamp"),
            F.when(~_k(6), F.concat(F.lit("win msg "), text(k))).alias("message"),
            winlog.alias("winlog"),
            F.struct(F.concat(F.lit("proc"), text(k % 8), F.lit(".exe")).alias("name")).alias("process"),
            F.when(rule.isNotNull(), F.struct(rule.alias("name"))).alias("rule"),
        )
    )


def audit_message() -> Column:
    """Command-audit text: ten fields for even k, five for odd k, two (broken) for k%10=9."""
    k, eid = text(F.col("k")), text(F.col("event_id"))
    n = text(F.col("k") % 10)
    ssh = F.when(_k(4), F.lit("(undefined)")).otherwise(
        F.concat(F.lit("("), F.col("kip"), F.lit(" "), text(F.col("k") + 1000), F.lit(" "), F.col("uip"), F.lit(" 22)"))
    )
    cmd = F.concat(F.lit("]: cmd"), n, F.lit(" -a "), eid)
    file = F.concat(F.lit(" cwd:/root filename:/bin/cmd"), n)
    long = F.concat(
        F.lit("[login:user"), text(F.col("uid")), F.lit(" ssh:"), ssh,
        F.lit(" username:root uid:0 group:domain users gid:0 sid:"), k, F.lit(" tty:(none)"), file, cmd,
    )
    short = F.concat(F.lit("[uid:0 sid:"), k, F.lit(" tty:(none)"), file, cmd)
    return F.when(_k(10, 9), F.lit("[uid:0 sid:9]: ls")).when(_k(2), long).otherwise(short)


def cef_message() -> Column:
    k = text(F.col("k"))
    return F.concat(
        F.lit("CEF: 0|Vendor|Product|1.0|"), k, F.lit("|Decoy hit|"), text(F.col("k") % 10),
        F.lit("|src="), F.col("kip"), F.lit(" dst="), F.col("uip"), F.lit(" msg=decoy "), k,
        F.lit(" touched dvchost="), F.col("host"), F.lit(" empty= end="),
    )


def header_parts() -> dict[str, Column]:
    """pri, host, app and message of the wrapped kinds."""
    syslog = F.col("kind") == "syslog"
    cef = syslog & _k(20, 13)
    app = (
        F.when(F.col("kind") == "snoopy", "snoopy")
        .when(F.col("kind") == "suricata", "suricata")
        .when(cef, "CEF")
        .when(_k(7), "-")
        .otherwise(F.concat(F.lit("app"), text(F.col("k") % 5)))
    )
    host = F.when(cef, F.when(_k(40, 33), "Mendel").otherwise("MazeRunner")).otherwise(F.col("host"))
    message = (
        F.when(F.col("kind") == "snoopy", audit_message())
        .when(
            F.col("kind") == "suricata",
            F.when(_k(2), F.concat(F.lit("LOGSTASH[-]: "), eve_json())).otherwise(F.concat(F.lit(" "), eve_json())),
        )
        .when(cef, cef_message())
        .when(_k(20, 3), F.concat(F.lit('@cee: {"Hostname":"'), F.col("host"), F.lit('"}')))
        .otherwise(F.concat(F.lit("event "), text(F.col("event_id")), F.lit(" value "), text(F.col("k"))))
    )
    return {"pri": (F.col("k") * 7) % 192, "host": host, "app": app, "message": message}


def envelope(df: DataFrame, value: Column, topic: Column) -> DataFrame:
    """Envelope columns; the offset is the event id."""
    return df.select(
        value.alias("value"),
        text(F.col("uid") % 7).alias("key"),
        topic.alias("topic"),
        (F.col("event_id") % 4).cast("int").alias("partition"),
        F.col("event_id").alias("offset"),
        F.col("ts").alias("timestamp"),
    )


def raw_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What arrives on the raw topics: RFC 5424 lines, or bare JSON for the Windows kinds.

    Syslog and Suricata lines with k%10=9 are broken on purpose.
    """
    ev = base_events(spark, sf_dir)
    p = header_parts()
    line = F.concat(
        F.lit("<"), text(p["pri"]), F.lit(">1 "), rfc3339_text(F.col("ts")), F.lit(" "), p["host"], F.lit(" "),
        p["app"], F.lit(" "), text(F.col("k")), F.lit(" ID"), text(F.col("k")), F.lit(' [x@1 k="'),
        text(F.col("k")), F.lit('"] '), p["message"],
    )
    broken = F.concat(F.lit("broken line "), text(F.col("event_id")))
    value = (
        F.when(F.col("kind").isin("windows", "sysmon"), winlog_json())
        .when(F.col("kind").isin("syslog", "suricata") & _k(10, 9), broken)
        .otherwise(line)
    )
    return envelope(ev, value, F.concat(F.lit("raw-"), F.col("kind")))


def syslog_json() -> Column:
    pri = (F.col("k") * 7) % 192
    label = lambda labels, code: F.get(F.array(*[F.lit(x) for x in labels]), code.cast("int"))
    return F.to_json(
        F.struct(
            rfc3339_text(F.col("ts")).alias("@timestamp"),
            F.col("host").alias("syslog_host"),
            F.concat(F.lit("app"), text(F.col("k") % 5)).alias("syslog_program"),
            label(SEVERITIES, pri % 8).alias("syslog_severity"),
            label(FACILITIES, int_div(pri, 8)).alias("syslog_facility"),
            F.concat(F.lit("event "), text(F.col("event_id")), F.lit(" value "), text(F.col("k"))).alias("syslog_message"),
            F.when(_k(4), F.col("uip")).alias("syslog_ip"),
        )
    )


def snoopy_json() -> Column:
    n = text(F.col("k") % 10)
    ssh = F.when(
        _k(2) & ~_k(4),
        F.struct(
            F.lit("22").alias("dst_port"),
            F.col("uip").alias("dst_ip"),
            text(F.col("k") + 1000).alias("src_port"),
            F.col("kip").alias("src_ip"),
        ),
    )
    return F.to_json(
        F.struct(
            F.concat(F.lit(" cmd"), n, F.lit(" -a "), text(F.col("event_id"))).alias("cmd"),
            F.concat(F.lit("/bin/cmd"), n).alias("filename"),
            F.lit("/root").alias("cwd"),
            F.lit("root").alias("username"),
            F.concat(F.lit("user"), text(F.col("uid"))).alias("login"),
            ssh.alias("ssh"),
            rfc3339_text(F.col("ts")).alias("@timestamp"),
            F.col("host").alias("syslog_host"),
            F.lit("snoopy").alias("syslog_program"),
            F.lit("notice").alias("syslog_severity"),
            F.lit("user-level messages").alias("syslog_facility"),
            F.lit("").alias("syslog_message"),
        )
    )


def json_events(spark: SparkSession, sf_dir: str, broken: bool = False) -> DataFrame:
    """What arrives on the normalised topics, with ``kind``. ``broken`` spoils rows with k%10=9.

    A file of few row groups is few tasks, however many rows it has; the narrow rows are dealt out before the work.
    """
    ev = base_events(spark, sf_dir).repartition(spark.sparkContext.defaultParallelism, "event_id")
    value = (
        F.when(F.col("kind") == "syslog", syslog_json())
        .when(F.col("kind") == "snoopy", snoopy_json())
        .when(F.col("kind") == "suricata", eve_json())
        .otherwise(winlog_json())
    )
    if broken:
        value = F.when(_k(10, 9), F.substr(value, F.lit(1), F.length(value) - 3)).otherwise(value)
    out = envelope(ev, value, F.concat(F.lit("raw-"), F.col("kind")))
    kind = F.substr("topic", F.lit(5))
    return out.withColumn("kind", kind)


def time_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """path, offset, value: JSON lines cut in files of a fixed number of event ids.

    k%25=24 cannot be read, k%10=9 holds broken escapes, k%13=0 has no time.
    """
    ev = base_events(spark, sf_dir)
    stamp = F.when(_k(13), F.lit("")).otherwise(
        F.concat(F.lit('"@timestamp":"'), rfc3339_text(F.col("ts")), F.lit('",'))
    )
    note = F.when(_k(10, 9), F.lit(r"\(x\) \*")).otherwise(F.lit("plain"))
    good = F.concat(F.lit("{"), stamp, F.lit('"event_id":'), text(F.col("event_id")), F.lit(',"note":"'), note, F.lit('"}'))
    value = F.when(_k(25, 24), F.lit("{broken")).otherwise(good)
    return ev.select(
        text(int_div(F.col("event_id"), LINES_PER_FILE)).alias("path"),
        (F.col("event_id") % LINES_PER_FILE).alias("offset"),
        value.alias("value"),
        "event_id",
    )


def log_folder(spark: SparkSession, sf_dir: str) -> str:
    """Write the time lines as gzip text, one file per ``path``, and return the folder."""
    lines = time_lines(spark, sf_dir).withColumnRenamed("path", "file")
    path = scratch_path(spark, "logs")
    (
        lines.repartition("file")
        .sortWithinPartitions("file", "offset")
        .select("file", "value")
        .write.partitionBy("file")
        .option("compression", "gzip")
        .text(path)
    )
    return path


def file_of(path: Column) -> Column:
    return F.regexp_extract(path, r"file=(\d+)", 1)


def file_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """dir, path, first_ts, last_ts, lines of the same files, from the events themselves."""
    ev = base_events(spark, sf_dir)
    path = int_div(F.col("event_id"), LINES_PER_FILE)
    return ev.groupBy(path.alias("n")).agg(
        F.min("ts").alias("first_ts"), F.max("ts").alias("last_ts"), F.count(F.lit(1)).alias("lines")
    ).select(text(F.col("n") % 2).alias("dir"), text(F.col("n")).alias("path"), "first_ts", "last_ts", "lines")


# --- dimensions -------------------------------------------------------------------------------


def _supplier(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = F.col("s_suppkey")
    domain = F.when(s % 5 == 0, F.lit("")).otherwise(F.concat(F.lit("n"), text(F.col("s_nationkey")), F.lit(".example")))
    host = F.concat(F.lit("host-"), text(s))
    return table(spark, sf_dir, "supplier").select(
        s.alias("s"),
        F.col("s_nationkey").alias("n"),
        host.alias("host_name"),
        domain.alias("domain"),
        F.when(domain != "", F.concat(host, F.lit("."), domain)).otherwise(host).alias("fqdn"),
        F.when(s % 2 == 0, "blue").otherwise("red").alias("team"),
        F.concat(F.lit("role-"), text(s % 3)).alias("role"),
    )


def records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Inventory records with ``seq``; every tenth machine appears again later with other facts."""
    s = F.col("s")
    base = _supplier(spark, sf_dir).select(
        F.concat(F.lit("vm_"), text(s)).alias("ansible_name"),
        "host_name",
        F.concat(F.lit("pretty-"), text(s)).alias("pretty"),
        "domain",
        "role",
        ip_of(s).alias("addr"),
        "team",
        F.when(s % 2 == 0, "os_linux").otherwise("os_windows").alias("os"),
        F.concat(F.lit("net-"), text(F.col("n"))).alias("network_name"),
        F.timestamp_seconds(F.lit(1704067200) + s).alias("updated"),
        "fqdn",
        s.alias("seq"),
    )
    copies = F.array(F.lit(0), F.lit(1))
    both = base.withColumn("c", F.explode(F.when(F.col("seq") % 10 == 0, copies).otherwise(F.array(F.lit(0)))))
    again = F.col("c") == 1
    changed = {
        "addr": F.when(again, ip_of(F.col("seq"), "172")).otherwise(F.col("addr")),
        "team": F.when(again, "green").otherwise(F.col("team")),
        "updated": F.when(again, F.timestamp_seconds(F.lit(1704153600) + F.col("seq"))).otherwise(F.col("updated")),
    }
    seq = F.when(again, F.col("seq") + 1_000_000_000).otherwise(F.col("seq"))
    return both.select(*[changed.get(c, F.col(c)).alias(c) for c in RECORD_COLUMNS], seq.alias("seq"))


def target_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nested inventory targets, one per supplier."""
    s = F.col("s")
    strings = lambda *xs: F.array(*[F.lit(x) for x in xs])
    tags = (
        F.when(s % 11 == 0, F.array().cast("array<string>"))
        .when(s % 3 == 0, strings("os_linux", "x", "os_windows"))
        .when(s % 3 == 1, strings("y", "os_linux"))
        .otherwise(strings("z"))
    )

    def address(value: Column) -> Column:
        return F.struct(F.lit("p").alias("pool_id"), value.alias("address"))

    v4 = F.when(s % 13 == 0, F.lit("bad")).otherwise(F.concat(ip_of(s), F.lit("/24")))
    v6 = F.concat(F.lit("FD00:0:0:0::"), F.hex(s % 65536), F.lit("/64"))
    face = F.struct(
        F.concat(F.lit("net-"), text(F.col("n"))).alias("network_id"), F.array(address(v4), address(v6)).alias("addresses")
    )
    instance = F.struct(
        F.concat(F.lit("vm_"), text(s)).alias("id"),
        F.concat(F.lit("name-"), text(s)).alias("vm_name"),
        F.col("host_name").alias("hostname"),
        "domain",
        "fqdn",
        F.array(face).alias("interfaces"),
    )
    empty = F.when(s % 7 == 0, F.lit(None)).otherwise(F.array(instance))
    return _supplier(spark, sf_dir).select(
        F.concat(F.lit("t"), text(s)).alias("id"),
        "role",
        F.col("team").alias("team_name"),
        tags.alias("tags"),
        empty.alias("instances"),
        s.alias("s"),
    )


def _documents(rows: DataFrame, order: str, field: str, path: str) -> None:
    """Write rows as JSON documents ``{field: [...]}`` of a bounded number of entries each."""
    body = [c for c in rows.columns if c != order]
    doc = F.lpad(text(int_div(F.col(order), OBJECTS_PER_DOC)), 12, "0")
    grouped = rows.groupBy(doc.alias("doc")).agg(
        F.transform(F.array_sort(F.collect_list(F.struct(order, F.struct(*body).alias("x")))), lambda e: e["x"]).alias(field)
    )
    grouped.select("doc", F.to_json(F.struct(field)).alias("value")).write.partitionBy("doc").text(path)


def targets_file(spark: SparkSession, sf_dir: str) -> str:
    path = scratch_path(spark, "targets")
    _documents(target_rows(spark, sf_dir), "s", "result", path)
    return path


def stix_file(spark: SparkSession, sf_dir: str) -> str:
    """ATT&CK bundles from parts: revoked when p_size%7=0, another type when p_size%5=0."""
    p, size = F.col("p_partkey"), F.col("p_size")
    phases = F.array(
        F.struct(F.lit("mitre-attack").alias("kill_chain_name"), F.lower("p_type").alias("phase_name")),
        F.struct(F.lit("other").alias("kill_chain_name"), F.lit("x").alias("phase_name")),
    )

    def ref(name: str, ident: Column) -> Column:
        return F.struct(
            F.lit(name).alias("source_name"), ident.alias("external_id"),
            F.concat(F.lit("https://example.org/"), ident).alias("url"),
        )

    rows = table(spark, sf_dir, "part").select(
        p.alias("p_partkey"),
        F.concat(F.lit("attack-pattern--"), text(p)).alias("id"),
        F.col("p_name").alias("name"),
        F.when(size % 7 == 0, F.lit(True)).alias("revoked"),
        F.when(size % 5 == 0, "malware").otherwise("attack-pattern").alias("type"),
        F.when(size % 3 != 0, phases).alias("kill_chain_phases"),
        F.array(ref("mitre-attack", technique_id(p)), ref("other", F.lit("CAPEC-1"))).alias("external_references"),
    )
    path = scratch_path(spark, "stix")
    _documents(rows, "p_partkey", "objects", path)
    return path


def techniques(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Technique table (at most 1000 ids) straight from the parts, newest part per id."""
    p, size = F.col("p_partkey"), F.col("p_size")
    live = table(spark, sf_dir, "part").filter((size % 7 != 0) & (size % 5 != 0))
    phases = F.when(size % 3 != 0, F.array(F.lower("p_type")))
    row = F.struct(
        F.col("p_name").alias("Name"),
        F.concat(F.lit("https://example.org/"), technique_id(p)).alias("URL"),
        phases.alias("Phases"),
    )
    return live.groupBy(technique_id(p).alias("ID")).agg(F.max_by(row, p).alias("t")).select("ID", "t.*")


def sid_map_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").select(
        F.col("p_partkey").cast("int").alias("sid"),
        F.lower("p_type").alias("tactic"),
        technique_id(F.col("p_partkey")).alias("id"),
        F.col("p_name").alias("name"),
        F.concat(F.lit('msg "'), F.col("p_brand"), F.lit('", '), text(F.col("p_size"))).alias("msg"),
    )


def networks_file(spark: SparkSession, sf_dir: str) -> str:
    """One column-oriented document; nations are a fixed list, so it stays small."""
    n = F.col("n_nationkey").cast("int")
    base = n * 16
    v4 = F.concat(ip_of(base), F.lit("\\/28"))
    rows = table(spark, sf_dir, "nation").select(
        text(n).alias("id"), F.col("n_name").alias("name"), F.concat(F.lit("N"), text(n)).alias("abbr"),
        F.concat(F.lit("VLAN-"), text(n + 100)).alias("vlan"), v4.alias("v4"),
        F.concat(F.lit("fd00:"), F.lower(F.hex(n + 16)), F.lit("::\\/32")).alias("v6"),
        F.when(n % 2 == 0, "blue").otherwise("red").alias("team"),
    )

    def column(name: str) -> Column:
        return F.map_from_entries(F.collect_list(F.struct("id", name)))

    doc = rows.agg(
        column("name").alias("Name"), column("abbr").alias("Abbreviation"), column("vlan").alias("VLAN/Portgroup"),
        column("v4").alias("IPv4"), column("v6").alias("IPv6"), column("name").alias("Description"),
        column("abbr").alias("WHOIS"), column("team").alias("Team"),
    )
    path = scratch_path(spark, "networks")
    doc.write.json(path)
    return path


def networks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nations as /28 blocks under one /24, so that low addresses lie in two segments."""
    n = F.col("n_nationkey").cast("int")
    blocks = table(spark, sf_dir, "nation").select(
        n.alias("id"), F.col("n_name").alias("name"), F.concat(F.lit("VLAN-"), text(n + 100)).alias("vlan"),
        F.concat(ip_of(n * 16), F.lit("/28")).alias("ipv4"),
        F.concat(F.lit("fd00:"), F.lower(F.hex(n + 16)), F.lit("::/32")).alias("ipv6"),
    )
    wide = table(spark, sf_dir, "region").filter("r_regionkey = 0").select(
        F.lit(100).alias("id"), F.lit("wide").alias("name"), F.lit("VLAN-0").alias("vlan"),
        F.lit("10.0.0.0/24").alias("ipv4"), F.lit(None).cast("string").alias("ipv6"),
    )
    return blocks.unionByName(wide)


def vcenter_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """VM report: two suppliers of three with fresh addresses, and customers nobody knows."""
    s, c = F.col("s_suppkey"), F.col("c_custkey")
    known = table(spark, sf_dir, "supplier").filter(s % 3 != 0).select(
        F.timestamp_seconds(F.lit(1706745600) + s).alias("ts"), F.concat(F.lit("vm_"), text(s)).alias("name"),
        F.concat(ip_of(s, "11"), F.lit("/24")).alias("ip"), s.alias("n"),
    )
    unknown = table(spark, sf_dir, "customer").select(
        F.timestamp_seconds(F.lit(1706745600) + c).alias("ts"),
        F.when(c % 50 == 0, F.lit("m_v")).otherwise(F.concat(F.lit("vm_c"), text(int_div(c, 3)))).alias("name"),
        F.when(c % 9 != 0, F.concat(ip_of(c, "12"), F.lit("/24"))).alias("ip"), (c + 1_000_000_000).alias("n"),
    )
    both = known.unionByName(unknown)
    return both.select(
        "ts", "name", F.concat(F.lit("h-"), F.col("name")).alias("host_name"), F.lit("d").alias("domain"), "ip",
        F.lit("00:00").alias("mac"), F.lit("blue").alias("team"), "n",
    )


def indicator_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reported indicators with ``seq``: six types, two bad ones, bad addresses and repeats."""
    c = F.col("c_custkey")
    slot = c % 8
    kinds = ("src_ip", "dest_ip", "tls.ja3.hash", "tls.ja3s.hash", "tls.sni", "http.hostname", "bogus", "")
    kind = F.lit(kinds[-1])
    for i, name in enumerate(kinds[:-1]):
        kind = F.when(slot == i, name).otherwise(kind)
    value = (
        F.when((slot < 2) & (c % 24 == 0), F.lit("not-ip"))
        .when(slot < 2, ip_of(c % 500, "10"))
        .when(slot < 4, F.md5(text(c % 300)))
        .when(c % 40 == 4, F.lit(""))
        .otherwise(F.concat(F.lit("evil"), text(c % 300), F.lit(".example")))
    )
    return table(spark, sf_dir, "customer").select(kind.alias("type"), value.alias("value"), c.alias("seq"))


def prior_indicators(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = F.col("s_suppkey")
    return table(spark, sf_dir, "supplier").select(
        s.alias("id"), (s % 3 != 0).alias("enabled"), ip_of(s).alias("value"), F.lit("src_ip").alias("type"),
        F.timestamp_seconds(F.lit(1700000000) + s).alias("added"),
    )
