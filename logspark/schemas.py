"""Schemas of the inputs, as DDL."""

ENVELOPE = "value STRING, key STRING, topic STRING, partition INT, offset BIGINT, timestamp TIMESTAMP"

STIX_BUNDLE = (
    "objects ARRAY<STRUCT<id: STRING, name: STRING, revoked: BOOLEAN, type: STRING, "
    "kill_chain_phases: ARRAY<STRUCT<kill_chain_name: STRING, phase_name: STRING>>, "
    "external_references: ARRAY<STRUCT<source_name: STRING, external_id: STRING, url: STRING, description: STRING>>>>"
)

TECHNIQUE = "STRUCT<ID: STRING, Name: STRING, URL: STRING, Phases: ARRAY<STRING>>"

ADDRESS = (
    "STRUCT<pool_id: STRING, mode: STRING, connection: BOOLEAN, address: STRING, dns_enabled: BOOLEAN, gateway: STRING>"
)
INTERFACE = (
    "STRUCT<network_id: STRING, cloud_id: STRING, domain: STRING, fqdn: STRING, egress: BOOLEAN, "
    f"connection: BOOLEAN, addresses: ARRAY<{ADDRESS}>>"
)
INSTANCE = (
    "STRUCT<id: STRING, vm_name: STRING, team_unique_id: STRING, hostname: STRING, domain: STRING, fqdn: STRING, "
    f"connection_address: STRING, interfaces: ARRAY<{INTERFACE}>>"
)
TARGET = (
    "STRUCT<id: STRING, owner: STRING, description: STRING, role: STRING, team_name: STRING, bt_visible: BOOLEAN, "
    "hardware_cpu: INT, hardware_ram: INT, hardware_primary_disk_size: INT, tags: ARRAY<STRING>, "
    f"instances: ARRAY<{INSTANCE}>>"
)
INVENTORY = f"result ARRAY<{TARGET}>"

RECORD = (
    "ansible_name STRING, host_name STRING, pretty STRING, domain STRING, role STRING, addr STRING, team STRING, "
    "os STRING, network_name STRING, updated TIMESTAMP, fqdn STRING"
)
RECORD_COLUMNS = [part.split()[0] for part in RECORD.split(", ")]

VCENTER = "ts TIMESTAMP, name STRING, host_name STRING, domain STRING, ip STRING, mac STRING, team STRING"

SID_MAP = "sid INT, tactic STRING, id STRING, name STRING, msg STRING"

NETWORKS = ", ".join(
    f"`{name}` MAP<STRING, STRING>"
    for name in ("Name", "Abbreviation", "VLAN/Portgroup", "IPv4", "IPv6", "Description", "WHOIS", "Team")
)

KNOWN_TIMES = "`@timestamp` STRING, timestamp STRING, EventTime STRING, EventReceivedTime STRING"

ZEEK_NOTE = (
    "ts DOUBLE, uid STRING, `id.orig_h` STRING, `id.orig_p` INT, `id.resp_h` STRING, `id.resp_p` INT, proto STRING, "
    "note STRING, msg STRING, sub STRING, src STRING, dst STRING, p INT, actions ARRAY<STRING>, "
    "suppress_for DOUBLE, dropped BOOLEAN"
)

INDICATOR = "id BIGINT, enabled BOOLEAN, value STRING, type STRING, added TIMESTAMP"

ASSET_FIELDS = ["Host", "Alias", "OS", "IP", "Zone", "Team", "Domain", "VM", "Role"]
ASSET = "STRUCT<" + ", ".join(f"{f}: STRING" for f in ASSET_FIELDS) + ", is_asset: BOOLEAN>"
