"""Events joined with the asset registry, detection rules and techniques.

The full job is one narrow stage when the registry is small enough to broadcast: decode, a
projection of the lookup keys, four hash lookups, and one projection that builds ``GameMeta``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from logspark.fixed import DIRECTIONS, SYSLOG_FIELDS
from logspark.functions.binding import with_fields
from logspark.functions.dynamic import dot_string
from logspark.functions.ip import canon_ip
from logspark.functions.joins import Lookup, as_lookup, attach
from logspark.functions.times import rfc3339_text
from logspark.operators.decode import decode
from logspark.operators.fields import event_data, event_time, rec
from logspark.operators.rules import Rule, match_rules
from logspark.schemas import ASSET, ASSET_FIELDS, TECHNIQUE

SPREAD = ["topic", "partition", "offset"]


def event_type() -> Column:
    """Kind label an event reports; sysmon rows report the Windows label."""
    return F.when(F.col("kind") == "sysmon", F.lit("windows")).otherwise(F.col("kind"))


def template_fields() -> list[Column]:
    """What an event says about the machines in it, before any lookup."""
    kind = F.col("kind")
    struct_kind = kind.isin("syslog", "snoopy")
    suricata = kind == "suricata"
    ssh = rec("ssh")
    src_text = F.when(suricata, dot_string("v", "src_ip", strict=True))
    dest_text = F.when(suricata, dot_string("v", "dest_ip", strict=True))
    return [
        F.when(struct_kind, rec("syslog_host"))
        .when(suricata, F.coalesce(dot_string("v", "host", strict=True), F.lit("")))
        .otherwise(F.coalesce(dot_string("v", "winlog.computer_name", strict=True), F.lit("")))
        .alias("host"),
        F.when(struct_kind, rec("syslog_ip")).alias("ip"),
        F.when(suricata, src_text.isNotNull())
        .when(kind == "snoopy", F.coalesce(ssh["has_src_ip"], F.lit(False)))
        .otherwise(F.lit(False))
        .alias("has_src"),
        F.when(suricata, dest_text.isNotNull())
        .when(kind == "snoopy", F.coalesce(ssh["has_dst_ip"], F.lit(False)))
        .otherwise(F.lit(False))
        .alias("has_dest"),
        F.when(suricata, canon_ip(src_text)).when(kind == "snoopy", ssh["src_ip"]).alias("src_ip"),
        F.when(suricata, canon_ip(dest_text)).when(kind == "snoopy", ssh["dst_ip"]).alias("dest_ip"),
    ]


def blank_asset(df: DataFrame) -> DataFrame:
    """Add host, ip, has_src, has_dest, src_ip and dest_ip to a decoded frame."""
    return with_fields(df, template_fields())


def _template(host: Column, ip: Column) -> Column:
    """Asset struct that knows only a host name and an address."""
    known = {"Host": host, "IP": ip}
    return F.struct(
        *[known.get(name, F.lit("")).alias(name) for name in ASSET_FIELDS], F.lit(False).alias("is_asset")
    ).cast(ASSET)


def join_assets(df: DataFrame, index: Lookup, spread: list[str] | None = None) -> DataFrame:
    """Self lookup: by address, else by host. A hit replaces the template.

    Adds ``asset``, ``host_asked`` (the host, where it was looked up: no address answered) and ``host_missed``.
    """
    spread = spread or SPREAD
    out = attach(df, index, F.col("ip"), "__by_ip", spread)
    host = F.when(F.col("__by_ip").isNull() & (F.col("host") != ""), F.col("host"))
    out = attach(out, index, host, "__by_host", spread)
    found = F.coalesce("__by_ip", "__by_host")
    return (
        out.withColumn("asset", F.coalesce(found, _template(F.col("host"), F.col("ip"))))
        .withColumn("host_asked", host)
        .withColumn("host_missed", F.coalesce((F.col("host") != "") & found.isNull(), F.lit(False)))
        .drop("__by_ip", "__by_host")
    )


def join_endpoints(df: DataFrame, index: Lookup, spread: list[str] | None = None) -> DataFrame:
    """Source and destination lookups by address. Adds ``src`` and ``dest`` (null: no endpoint)."""
    spread = spread or SPREAD
    out = attach(df, index, F.when(F.col("has_src"), F.col("src_ip")), "__src", spread)
    out = attach(out, index, F.when(F.col("has_dest"), F.col("dest_ip")), "__dest", spread)
    src = F.when(F.col("has_src"), F.coalesce("__src", _template(F.lit(""), F.col("src_ip"))))
    dest = F.when(F.col("has_dest"), F.coalesce("__dest", _template(F.lit(""), F.col("dest_ip"))))
    return out.withColumn("src", src).withColumn("dest", dest).drop("__src", "__dest")


def missing_hosts(df: DataFrame, index: DataFrame) -> DataFrame:
    """Distinct hosts that no registry key answers to.

    Rows found by their address never look at the host. Distinct pairs are taken first, so the
    anti joins see each host once.
    """
    asked = df.filter(F.col("host") != "").select("host", "ip").distinct()
    keys = index.select("key")
    no_ip = asked.join(keys.withColumnRenamed("key", "ip"), "ip", "left_anti")
    return no_ip.select("host").distinct().join(keys.withColumnRenamed("key", "host"), "host", "left_anti")


def host_answers(joined: DataFrame) -> DataFrame:
    """(host, present): each host that was looked up, and whether nothing answered to it.

    ``joined`` has ``host_asked`` and ``host_missed``. The registry does not change within a batch, so all rows of a
    host agree; they are reduced before they are shuffled.
    """
    asked = joined.filter(F.col("host_asked").isNotNull())
    return asked.groupBy(F.col("host_asked").alias("host")).agg(F.bool_or("host_missed").alias("present"))


def event_technique() -> Column:
    """Technique an event names itself: STRUCT<ID, Name, URL, Phases>, null when none.

    Suricata: a one-element array of string. Windows: ``a=ID,b=Name`` with exactly one comma and
    exactly one equals sign in the first part; the id is upper-cased.
    """
    kind = F.col("kind")
    ids = "try_variant_get(v, '$.alert.metadata.mitre_technique_id', 'array<variant>')"
    suricata = F.expr(
        f"CASE WHEN size({ids}) = 1 AND schema_of_variant(get({ids}, 0)) = 'STRING' "
        f"THEN cast(get({ids}, 0) as string) END"
    )
    parts = F.split(dot_string("v", "rule.name"), ",")
    first, second = F.split(F.get(parts, F.lit(0)), "="), F.split(F.get(parts, F.lit(1)), "=")
    ok = (F.size(parts) == 2) & (F.size(first) == 2)
    windows = F.when(ok, F.upper(F.get(first, F.lit(1))))
    name = F.when(F.size(second) == 2, F.get(second, F.lit(1))).otherwise(F.lit(""))

    def technique(ident: Column, label: Column) -> Column:
        return F.when(
            ident.isNotNull(),
            F.struct(
                ident.alias("ID"), label.alias("Name"), F.lit("").alias("URL"),
                F.lit(None).cast("array<string>").alias("Phases"),
            ).cast(TECHNIQUE),
        )

    return F.when(kind == "suricata", technique(suricata, F.lit(""))).when(
        kind.isin("windows", "sysmon"), technique(windows, name)
    )


def fill_techniques(
    df: DataFrame, techniques: Lookup, col: str = "technique", spread: list[str] | None = None
) -> DataFrame:
    """Name, phases and URL of a known technique; an unknown one is kept as it is."""
    out = attach(df, techniques, F.col(col)["ID"], "__known", spread or SPREAD)
    filled = F.struct(
        F.col(col)["ID"].alias("ID"),
        F.col("__known")["Name"].alias("Name"),
        F.col("__known")["URL"].alias("URL"),
        F.col("__known")["Phases"].alias("Phases"),
    ).cast(TECHNIQUE)
    return out.withColumn(
        col, F.when(F.col("__known").isNotNull(), filled).otherwise(F.col(col))
    ).drop("__known")


def dedupe_techniques(techniques: Column) -> Column:
    """First technique per id, in order."""
    ids = F.transform(techniques, lambda t: t["ID"])
    return F.filter(techniques, lambda t, i: F.array_position(ids, t["ID"]) == i + 1)


def finalize_attack(own: Column, tagged: Column, always: Column) -> Column:
    """Attack block: own technique, then those of matching rules, one per id.

    ``always`` marks kinds whose block exists even when empty. The headline is the first entry.
    """
    listed = dedupe_techniques(
        F.concat(
            F.when(own.isNotNull(), F.array(own)).otherwise(F.expr(f"cast(array() as array<{TECHNIQUE}>)")),
            F.coalesce(tagged, F.expr(f"cast(array() as array<{TECHNIQUE}>)")),
        )
    )
    head = F.get(listed, F.lit(0))
    empty = F.size(listed) == 0
    return F.when(
        ~empty | always,
        F.struct(
            F.coalesce(head["ID"], F.lit("")).alias("ID"),
            F.coalesce(head["Name"], F.lit("")).alias("Name"),
            F.coalesce(head["URL"], F.lit("")).alias("URL"),
            head["Phases"].alias("Phases"),
            F.when(~empty, F.transform(listed, lambda t: t["Name"])).alias("Items"),
            listed.alias("Techniques"),
        ),
    )


def attack_contains(attack: Column, name: str) -> Column:
    return F.coalesce(F.exists(attack["Techniques"], lambda t: t["Name"] == name), F.lit(False))


def direction_code(has_src: Column, has_dest: Column, src_asset: Column, dest_asset: Column) -> Column:
    """Direction 0..4 from the two endpoints; one endpoint alone is Unknown."""
    return (
        F.when(~has_src & ~has_dest, F.lit(1))
        .when(~has_src | ~has_dest, F.lit(0))
        .when(src_asset & ~dest_asset, F.lit(4))
        .when(~src_asset & dest_asset, F.lit(3))
        .when(src_asset & dest_asset, F.lit(2))
        .otherwise(F.lit(0))
    )


def direction_label(code: Column) -> Column:
    return F.coalesce(F.get(F.array(*[F.lit(x) for x in DIRECTIONS]), code), F.lit(DIRECTIONS[0]))


def direction(df: DataFrame) -> DataFrame:
    """Add ``directionality`` and ``direction`` from has_src, has_dest, src and dest."""
    asset = lambda side: F.coalesce(F.col(side)["is_asset"], F.lit(False))
    out = df.withColumn(
        "directionality", direction_code(F.col("has_src"), F.col("has_dest"), asset("src"), asset("dest"))
    )
    return out.withColumn("direction", direction_label(F.col("directionality")))


def technique_lookup(techniques: DataFrame) -> Lookup:
    return as_lookup(techniques.select(F.col("ID").alias("key"), "Name", "URL", "Phases"), "key")


def enrich(
    events: DataFrame,
    index: Lookup,
    techniques: Lookup,
    rules: list[Rule] | None = None,
    col: str = "value",
    sysmon_rules: bool = False,
    use_signature: bool = False,
) -> DataFrame:
    """Envelope with ``kind`` -> envelope, event_time, ``GameMeta``, host_asked, host_missed, sigma_state, ``_error``."""
    carried = list(events.columns)
    decoded = decode(events, col)
    fields = [
        *template_fields(),
        event_technique().alias("technique"),
        event_data(use_signature).alias("event_data"),
        event_time().alias("event_time"),
    ]
    slim = with_fields(decoded, fields, [*carried, "v", "rec", "_error"])
    slim = match_rules(slim, rules or [], sysmon_rules).drop("v")
    out = join_endpoints(join_assets(slim, index), index)
    out = direction(fill_techniques(out, techniques))
    meta = F.struct(
        *[F.col("asset")[name].alias(name) for name in ASSET_FIELDS],
        F.col("asset")["is_asset"].alias("is_asset"),
        event_type().alias("EventType"),
        F.col("direction").alias("DirectionString"),
        F.col("directionality").alias("Directionality"),
        finalize_attack(
            F.col("technique"), F.col("sigma_techniques"), F.col("kind").isin("syslog", "snoopy")
        ).alias("MitreAttack"),
        F.col("sigma_results").alias("SigmaResults"),
        F.col("event_data").alias("EventData"),
        F.col("src").alias("Src"),
        F.col("dest").alias("Dest"),
    )
    ok = F.col("_error").isNull()
    kept = [*carried, "event_time", "rec", "host_asked", "host_missed", "sigma_state", "_error"]
    return with_fields(out, [F.when(ok, meta).alias("GameMeta")], kept)


def emit(require_technique: bool = False) -> Column:
    """Fast-track test: the event has an attack block.

    Syslog and audit rows always have one; ``require_technique`` asks for at least one technique.
    """
    block = F.col("GameMeta")["MitreAttack"]
    if require_technique:
        return F.coalesce(F.size(block["Techniques"]) > 0, F.lit(False))
    return block.isNotNull()


def to_output(df: DataFrame, col: str = "value") -> DataFrame:
    """Replace ``value`` by the enriched JSON: the event's own fields and ``GameMeta``, the block's null fields included.

    Struct kinds are printed from their fields, unset ones left out. Dynamic kinds keep the fields of their text; a
    ``GameMeta`` among them, wherever it stands, is replaced by the new block. Blocks deeper inside stay.
    """
    stamp = rfc3339_text(rec("timestamp")).alias("@timestamp")
    syslog = [rec(name).alias(name) for name in SYSLOG_FIELDS]
    audit = [
        F.when(rec(name) != "", rec(name)).alias(name)
        for name in ("cmd", "filename", "cwd", "tty", "sid", "gid", "group", "uid", "username", "login")
    ]
    ssh = F.when(
        rec("ssh").isNotNull(),
        F.struct(*[rec("ssh")[n].alias(n) for n in ("dst_port", "dst_ip", "src_port", "src_ip")]),
    ).alias("ssh")
    own = (
        F.when(F.col("kind") == "syslog", F.to_json(F.struct(stamp, *syslog)))
        .when(F.col("kind") == "snoopy", F.to_json(F.struct(*audit, ssh, stamp, *syslog)))
        .otherwise(F.col(col))
    )
    keep_nulls = {"ignoreNullFields": "false"}
    fields = F.try_variant_get(F.try_parse_json("__own"), "$", "map<string,variant>")
    block = F.from_json(F.to_json(F.struct("GameMeta"), keep_nulls), "map<string,variant>")
    out = with_fields(df, [own.alias("__own")])
    out = with_fields(out, [F.map_filter(fields, lambda k, v: k != "GameMeta").alias("__fields")], df.columns)
    text = F.to_json(F.map_concat("__fields", block), keep_nulls)
    others = [c for c in df.columns if c != col]
    done = with_fields(out, [F.when(F.col("_error").isNull(), text).otherwise(F.col(col)).alias("__text")], df.columns)
    return done.select(*others, F.col("__text").alias(col)).select(*df.columns)


def enrich_metrics(enriched: DataFrame) -> DataFrame:
    """Counters per kind: events, parse errors, rule results, alerts without a time."""
    good = F.col("_error").isNull()
    return enriched.groupBy("kind").agg(
        F.count(F.lit(1)).alias("events"),
        F.count_if(~good).alias("parse_errors"),
        F.count_if(good & (F.col("sigma_state") == "match")).alias("sigma_matches"),
        F.count_if(good & (F.col("sigma_state") == "miss")).alias("sigma_misses"),
        F.count_if(good & (F.col("sigma_state") == "no-ruleset")).alias("sigma_no_ruleset"),
        F.count_if(good & (F.col("kind") == "suricata") & F.col("event_time").isNull()).alias("missing_timestamp"),
    )


def observed(enriched: DataFrame, name: str) -> DataFrame:
    """Same rows, with the totals reported as an observation when the job runs."""
    return enriched.observe(
        name,
        F.count(F.lit(1)).alias("events"),
        F.count_if(F.col("_error").isNotNull()).alias("parse_errors"),
        F.count_if(F.col("sigma_state") == "match").alias("sigma_matches"),
        F.count_if(F.col("host_missed")).alias("host_misses"),
    )
