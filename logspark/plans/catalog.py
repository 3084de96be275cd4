"""Registry of queries and of the SQL that states their expected results."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from logspark.fixed import FACILITIES, SEVERITIES

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def register(fn: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"query {name} registered twice")
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return register


def _ip(expr: str, first: str = "10") -> str:
    return f"'{first}.'||((({expr})//65536)%256)||'.'||((({expr})//256)%256)||'.'||(({expr})%256)"


ip_sql = _ip

# The rendered facts of an event, computed from its own columns.
EV = f"""WITH ev AS (
  SELECT event_id, ts, user_id AS uid, event_type, value,
    CAST(json_extract_string(props, '$.k') AS BIGINT) AS k,
    CASE event_type WHEN 'click' THEN 'syslog' WHEN 'view' THEN 'snoopy' WHEN 'purchase' THEN 'suricata'
      WHEN 'signup' THEN 'windows' WHEN 'error' THEN 'sysmon' END AS kind,
    'host-'||user_id AS host,
    {_ip('user_id')} AS uip,
    '10.0.0.'||CAST(json_extract_string(props, '$.k') AS BIGINT) AS kip
  FROM events)
"""

# Inventory records with arrival order, and the registry in which the first record keeps a key.
RECORDS = f"""
  base AS (
    SELECT s_suppkey AS s, s_nationkey AS n, 'host-'||s_suppkey AS host_name,
      CASE WHEN s_suppkey%5=0 THEN '' ELSE 'n'||s_nationkey||'.example' END AS domain
    FROM supplier),
  rec AS (
    SELECT s, s AS seq, 'vm_'||s AS ansible_name, host_name, 'pretty-'||s AS pretty, domain, 'role-'||(s%3) AS role,
      {_ip('s')} AS addr, CASE WHEN s%2=0 THEN 'blue' ELSE 'red' END AS team,
      CASE WHEN s%2=0 THEN 'os_linux' ELSE 'os_windows' END AS os, 'net-'||n AS network_name,
      1704067200 + s AS updated, CASE WHEN domain<>'' THEN host_name||'.'||domain ELSE host_name END AS fqdn
    FROM base
    UNION ALL
    SELECT s, s + 1000000000, 'vm_'||s, host_name, 'pretty-'||s, domain, 'role-'||(s%3), {_ip('s', '172')}, 'green',
      CASE WHEN s%2=0 THEN 'os_linux' ELSE 'os_windows' END, 'net-'||n, 1704153600 + s,
      CASE WHEN domain<>'' THEN host_name||'.'||domain ELSE host_name END
    FROM base WHERE s%10=0),
  keyed AS (
    SELECT DISTINCT key, rec.* FROM rec, unnest([host_name, ansible_name, pretty, addr, CASE WHEN domain<>'' THEN fqdn END]) AS u(key)
    WHERE key IS NOT NULL AND key <> ''),
  idx AS (SELECT * FROM keyed QUALIFY row_number() OVER (PARTITION BY key ORDER BY seq) = 1)
"""

# Technique table: the newest live part per id.
TECH = """
  tech AS (
    SELECT 'T1'||lpad(CAST(p_partkey%1000 AS VARCHAR), 3, '0') AS id, p_name AS name, lower(p_type) AS ptype, p_size
    FROM part WHERE p_size%7<>0 AND p_size%5<>0
    QUALIFY row_number() OVER (PARTITION BY p_partkey%1000 ORDER BY p_partkey DESC) = 1)
"""

TECH_ID = "'T1'||lpad(CAST(k AS VARCHAR), 3, '0')"
SEVERITY_SQL = "['" + "', '".join(SEVERITIES) + "']"
FACILITY_SQL = "['" + "', '".join(FACILITIES) + "']"
PRI = "((k*7)%192)"
EVE_ALERT = "(kind='suricata' AND k%5<>0)"
EVE_TECH = "(kind='suricata' AND k%5<>0 AND k%3=0)"
WIN_TECH = "(kind IN ('windows','sysmon') AND k%3=0 AND k%11<>0)"
