"""Names, formats and texts that outputs must reproduce exactly."""

# Event kinds that configuration may name, in priority order.
KINDS = ("suricata", "syslog", "snoopy", "windows", "sysmon")
# All kind labels, including those that only code can produce.
ALL_KINDS = KINDS + ("zeek", "mazerunner", "timestamp parser", "atomic")
DYNAMIC_KINDS = ("suricata", "windows", "sysmon")
# Parser names a source may ask for; anything else means the last one.
PARSERS = ("rfc5424", "json-raw", "json-peek")

# Syslog severity keywords, by code 0..7.
SEVERITIES = ("emergency", "alert", "critical", "error", "warning", "notice", "informational", "debug")

# Syslog facility texts (RFC 5424, table 1), by code 0..23.
FACILITIES = (
    "kernel messages",
    "user-level messages",
    "mail system",
    "system daemons",
    "security/authorization messages",
    "messages generated internally by syslogd",
    "line printer subsystem",
    "network news subsystem",
    "UUCP subsystem",
    "clock daemon",
    "security/authorization messages",
    "FTP daemon",
    "NTP subsystem",
    "log audit",
    "log alert",
    "clock daemon",
    "local use 0 (local0)",
    "local use 1 (local1)",
    "local use 2 (local2)",
    "local use 3 (local3)",
    "local use 4 (local4)",
    "local use 5 (local5)",
    "local use 6 (local6)",
    "local use 7 (local7)",
)

# Hosts whose "CEF" program lines carry honeypot records.
CEF_HOSTS = ("MazeRunner", "Mendel")

SYSMON_CHANNEL = "Microsoft-Windows-Sysmon/Operational"
SYSMON_SOURCE = "Microsoft-Windows-Sysmon"

# Command-audit header fields, in the order they are written.
AUDIT_FIELDS_LONG = ("login", "ssh", "username", "uid", "group", "gid", "sid", "tty", "cwd", "filename")
AUDIT_FIELDS_SHORT = ("uid", "sid", "tty", "cwd", "filename")
AUDIT_FIELDS = ("cmd", "filename", "cwd", "tty", "sid", "gid", "group", "uid", "username", "login")

SYSLOG_FIELDS = (
    "syslog_host",
    "syslog_program",
    "syslog_severity",
    "syslog_facility",
    "syslog_message",
    "syslog_ip",
)

# Traffic direction labels, by code 0..5.
DIRECTIONS = ("Unknown", "Local", "Lateral", "Inbound", "Outbound", "Network Pivot")

# Team whose machines count as defended assets.
DEFENDED_TEAM = "blue"

# Indicator types in listing order.
INDICATOR_TYPES = ("dest_ip", "src_ip", "tls.ja3.hash", "tls.ja3s.hash", "tls.sni", "http.hostname")

RULE_SID_OFFSET = 2_000_000_000
RULE_SECOND_SID_OFFSET = 1_000_000
RULE_REVISION = 3
RULE_METADATA = (
    "affected_product Any, attack_target Any, deployment Perimeter, tag YT, "
    "signature_severity Major, created_at 2021_11_30, updated_at 2021_11_30"
)
RULE_SRC_IP = (
    'alert ip [%s] any -> $HOME_NET any (msg:"XS YT IoC - %s - %s - Known Bad IP Inbound Traffic"; '
    "threshold: type limit, track by_dst, seconds 60, count 1; classtype:misc-attack; "
    "flowbits:set,YT.Evil; sid:%d; rev:%d; metadata:%s;)"
)
RULE_DEST_IP = (
    'alert ip $HOME_NET any -> [%s] any (msg:"XS YT IoC - %s - %s - Asset Connecting to Known Bad IP"; '
    "threshold: type limit, track by_src, seconds 60, count 1; classtype:misc-attack; "
    "flowbits:set,YT.Evil; sid:%d; rev:%d; metadata:%s;)"
)
RULE_JA3 = (
    'alert tls $HOME_NET any -> $EXTERNAL_NET any (msg:"XS YT IoC - %s - %s - Known Bad TLS Client '
    'Fingerprint Seen Outbound"; flow:established,to_server; flowbits:set,YT.Evil; ja3.hash; content:"%s"; '
    "classtype:trojan-activity; sid:%d; rev:%d; metadata:%s;)"
)
RULE_JA3_INBOUND = (
    'alert tls $EXTERNAL_NET any -> $HOME_NET any (msg:"XS YT IoC - %s - %s - Known Bad TLS Client '
    'Fingerprint Seen Inbound"; flow:established,to_server; flowbits:set,YT.Evil; ja3.hash; content:"%s"; '
    "classtype:trojan-activity; sid:%d; rev:%d; metadata:%s;)"
)
RULE_JA3S = (
    'alert tls $EXTERNAL_NET any -> $HOME_NET any (msg:"XS YT IoC - %s - %s - Known Bad TLS Server '
    'Fingerprint Seen in Response"; flow:established,to_client; flowbits:set,YT.Evil; ja3s.hash; content:"%s"; '
    "classtype:trojan-activity; sid:%d; rev:%d; metadata:%s;)"
)
RULE_TLS_SNI = (
    'alert tls $HOME_NET any -> $EXTERNAL_NET any (msg:"XS YT IoC - %s - %s - Asset Connecting to Known Bad TLS '
    'Server"; flow:to_server,established; tls.sni; content:"%s"; endswith; flowbits:set,YT.Evil; '
    "classtype:domain-c2; sid:%d; rev:%d; metadata:%s;)"
)
RULE_HTTP_HOST = (
    'alert http $HOME_NET any -> $EXTERNAL_NET any (msg:"XS YT IoC - %s - %s - Asset Connecting to Known Bad HTTP '
    'Site"; flow:established,to_server; http.host; content:"%s"; endswith; flowbits:set,YT.Evil; '
    "classtype:trojan-activity; sid:%d; rev:%d; metadata: %s;)"
)

# Header lines of the packet-capture tagger file.
TAGGER_HEADER = (
    "#field:target.name;shortcut:0",
    "#field:target.pretty;shortcut:1",
    "#field:target.team;shortcut:2",
    "#field:target.os;shortcut:3",
    "#field:target.network_name;shortcut:4",
)

SID_MAP_COLUMNS = ("sid", "tactic", "id", "name", "msg")
