"""Hand-written rows for the known oddities of each format."""

import json

import pytest
from pyspark.sql import functions as F

from logspark.operators import audit, cef, decode as dec, enrich as en, indicators as ioc, inventory as inv, syslog
from logspark.operators.rejects import split_rejects
from logspark.sources import topics as tp
from logspark.sources.logfiles import read_logs


def one(df, **_):
    rows = df.collect()
    assert len(rows) == 1
    return rows[0]


def values(spark, *texts, col="value"):
    return spark.createDataFrame([(t,) for t in texts], f"{col} STRING")


def test_rfc5424_lines(spark):
    df = values(
        spark,
        '<165>1 2024-01-01T00:09:58.778549Z host-13 app 123 ID47 [ex@32473 iut="3"] hello world',
        "<13>1 2024-01-01T00:09:58Z host-1 - - - - no app name",
        "<13>1 - - - - - -",
        "<192>1 2024-01-01T00:09:58Z h a - - - x",
        "not a syslog line",
    )
    now = F.lit("2020-01-01 00:00:00").cast("timestamp")
    rows = syslog.parse_rfc5424(df, now=now).collect()
    assert (rows[0].syslog_host, rows[0].syslog_program, rows[0].syslog_message) == ("host-13", "app", "hello world")
    assert (rows[0].syslog_severity, rows[0].syslog_facility) == ("notice", "local use 4 (local4)")
    assert rows[1].syslog_program == "" and rows[1].syslog_message == "no app name"
    assert rows[2]._error is None and rows[2].event_time.year == 2020 and rows[2].syslog_host == ""
    assert [r._error is not None for r in rows] == [False, False, False, True, True]
    good, bad = split_rejects(syslog.parse_rfc5424(df, now=now))
    assert (good.count(), bad.count()) == (3, 2)


def test_audit_lines(spark):
    long = ("[login:bob ssh:(1.2.3.4 555 10.0.0.1 22) username:root uid:0 group:domain users gid:0 sid:9 "
            "tty:(none) cwd:/root filename:/bin/ls]: ls -la")
    undefined = ("[login:bob ssh:(undefined) username:root uid:0 group:root gid:0 sid:9 tty:/dev/pts/0 cwd:/ "
                 "filename:/bin/id]: id")
    df = values(spark, long, undefined, "[uid:0 sid:9 tty:(none) cwd:/ filename:/bin/ls]: ls", "[uid:0 sid:9]: ls", col="syslog_message")
    a, b, c, d = audit.parse_snoopy(df).collect()
    assert (a.group, a.tty, a.cmd, a.ssh.src_ip, a.ssh.dst_port) == ("domain_users", "(none", " ls -la", "1.2.3.4", "22")
    assert b.ssh is None and b.tty == "/dev/pts/0"
    assert (c.tty, c.login, c.filename) == ("none", "", "/bin/ls")
    assert d._error and d.cmd is None


@pytest.mark.parametrize(
    "text, want",
    [
        ("src=1.2.3.4 dst=5.6.7.8 msg=hello world", {"src": "1.2.3.4", "dst": "5.6.7.8", "msg": "hello world"}),
        (r"aa=x\=y bb=2", {"aa": r"x\=y", "bb": "2"}),
        ("aa= bb=1", {"aa": "", "bb": "1"}),
        ("aa=1 bb=", {"aa": "1"}),
        ("src=1", {"src": "1"}),
        ("aa=1 aa=2", {"aa": "2"}),
        ("s=1", None),
    ],
)
def test_cef_extensions(spark, text, want):
    row = one(cef.parse_cef(values(spark, f"CEF: 0|v|p|1|7|n|3|{text}", col="syslog_message")))
    assert row.Extensions == want and (row._error is None) == (want is not None)


def test_cef_needs_eight_parts(spark):
    assert one(cef.parse_cef(values(spark, "0|v|p|1|7|n|3", col="syslog_message")))._error


def test_strict_strings_and_techniques(spark):
    texts = [
        {"event_type": "alert", "alert": {"metadata": {"mitre_technique_id": ["T1059"]}}},
        {"event_type": "alert", "alert": {"metadata": {"mitre_technique_id": []}}},
        {"event_type": "alert", "alert": {"metadata": {"mitre_technique_id": ["T1", "T2"]}}},
        {"event_type": "alert", "alert": {"metadata": {"mitre_technique_id": [5]}}},
        {"event_type": 5},
    ]
    df = spark.createDataFrame([(json.dumps(t), "suricata") for t in texts], "value STRING, kind STRING")
    rows = dec.decode(df).select(en.event_technique().alias("t")).collect()
    assert [r.t.ID if r.t else None for r in rows] == ["T1059", None, None, None, None]
    win = [{"rule": {"name": n}} for n in ("technique_id=t1059,technique_name=Command", "a=b", "a=b,c=d,e=f", "a=b=c,d=e")]
    df = spark.createDataFrame([(json.dumps(t), "windows") for t in win], "value STRING, kind STRING")
    rows = dec.decode(df).select(en.event_technique().alias("t")).collect()
    assert [(r.t.ID, r.t.Name) if r.t else None for r in rows] == [("T1059", "Command"), None, None, None]


def test_decode_rejects(spark):
    rows = [("{x", "suricata"), ("[1]", "windows"), ('{"syslog_message":5}', "syslog"), ('{"@timestamp":"x"}', "syslog"),
            ("{}", "zeek"), ("{}", "syslog")]
    out = dec.decode(spark.createDataFrame(rows, "value STRING, kind STRING")).select("_error").collect()
    assert [r._error is None for r in out] == [False] * 5 + [True]


def test_direction_needs_both_ends(spark):
    df = spark.createDataFrame([(a, b, x, y) for a in (True, False) for b in (True, False) for x in (True, False) for y in (True, False)],
                               "s BOOLEAN, d BOOLEAN, sa BOOLEAN, da BOOLEAN")
    for r in df.select("*", en.direction_code(*[F.col(c) for c in ("s", "d", "sa", "da")]).alias("c")).collect():
        if not r.s and not r.d:
            want = 1
        elif r.s != r.d:
            want = 0
        else:
            want = {(True, False): 4, (False, True): 3, (True, True): 2, (False, False): 0}[r.sa, r.da]
        assert r.c == want


def test_first_record_keeps_a_key(spark):
    rows = [("vm", "h", "p", "", "1.1.1.1", "f", "blue", 2), ("vm2", "h", "p2", "d", "2.2.2.2", "h.d", "red", 1)]
    df = spark.createDataFrame(rows, "ansible_name STRING, host_name STRING, pretty STRING, domain STRING, addr STRING, fqdn STRING, team STRING, seq INT")
    got = {r.key: r.seq for r in inv.asset_index(df).collect()}
    assert got == {"vm": 2, "p": 2, "1.1.1.1": 2, "h": 1, "vm2": 1, "p2": 1, "2.2.2.2": 1, "h.d": 1}


def test_disabled_and_double_rules(spark):
    df = spark.createDataFrame([(1, False, "ab", "tls.ja3.hash"), (2, True, "x", "other")], "id BIGINT, enabled BOOLEAN, value STRING, type STRING")
    rows = ioc.ioc_rules(df).orderBy("id", "line_no").collect()
    assert len(rows) == 3 and rows[0].rule.startswith("# alert") and "sid:2001000001;" in rows[1].rule
    assert rows[2].rule == "# unsupported ioc type for 2"


def test_topic_map_errors():
    assert tp.parse_topic_map(["a:syslog"]) == {"a": "syslog"}
    for bad in ([], ["a"], [":syslog"], ["a:"], ["a:zeek"], ["a:b:c"]):
        with pytest.raises(ValueError):
            tp.parse_topic_map(bad)


def test_line_numbers_over_split_files(spark, tmp_path):
    text = "".join(f"line {i} {'x' * (i % 50)}\n" for i in range(5000))
    (tmp_path / "big.log").write_text(text)
    (tmp_path / "small.log").write_text("line 0\nline 1\n")
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    try:
        df = read_logs(spark, str(tmp_path))
        assert df.rdd.getNumPartitions() > 3
        rows = df.select("offset", F.split("value", " ")[1].cast("bigint").alias("n")).collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert len(rows) == 5002 and all(r.offset == r.n for r in rows)


def test_splice_into_empty_object(spark):
    df = spark.createDataFrame([("{}", "suricata", "host")], "value STRING, kind STRING, h STRING")
    df = df.select("*", F.struct(F.col("h").alias("Host")).alias("GameMeta"), F.lit(None).cast("string").alias("_error"))
    rec = dec.decode(df.drop("_error")).drop("_error").withColumn("_error", F.lit(None).cast("string"))
    assert json.loads(one(en.to_output(rec)).value) == {"GameMeta": {"Host": "host"}}
