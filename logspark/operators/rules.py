"""Detection rules kept in a table and compiled into one expression per event kind.

A condition is Spark SQL over ``{field}`` placeholders, e.g.
``{process.name} LIKE '%cmd%' AND exists({keywords}, k -> contains(k, 'GET'))``. A field may be
asked for as a number with ``{#winlog.event_id}``.

The rule table is small by nature (people write rules) and its conditions must be known when the
plan is made, so the driver reads it. Conditions of a chunk become one SQL text that gives the numbers of the
matching rules; titles, tags and techniques come from one constant table by number. Each distinct field is extracted
once per event; conditions then only compare columns. Technique lookups for rule tags are done
here, once per rule, not per event.
"""

from __future__ import annotations

import json
import re
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, functions as F

from logspark.fixed import KINDS
from logspark.functions.binding import with_fields
from logspark.operators.fields import keywords, select_sql
from logspark.operators.rule_index import RuleIndex, matches, split_condition
from logspark.schemas import TECHNIQUE

CHUNK = 100
# From so many rules on, an index finds the few that an event matches.
INDEXED_FROM = 200
PLACEHOLDER = re.compile(r"\{(#?)([@\w.\-/ ]+)\}")
RESULT = "STRUCT<rule_id: STRING, title: STRING, tags: ARRAY<STRING>>"


@dataclass(frozen=True)
class Rule:
    rule_id: str
    title: str
    kind: str
    tags: tuple[str, ...]
    condition: str
    techniques: tuple[dict, ...] = field(default=())


def tag_technique_ids(rules: DataFrame) -> DataFrame:
    """rule_id, pos, technique id named by each ``attack.t…`` tag."""
    tags = rules.select("rule_id", F.posexplode("tags").alias("pos", "tag"))
    return tags.filter(F.startswith("tag", F.lit("attack.t"))).select(
        "rule_id", "pos", F.upper(F.substr("tag", F.instr("tag", ".") + 1)).alias("ID")
    )


def tag_techniques(rules: DataFrame, techniques: DataFrame) -> DataFrame:
    """rule_id -> ``techniques`` array of the known techniques its tags name, in tag order.

    Rules that name none are absent.
    """
    hit = tag_technique_ids(rules).join(techniques, "ID")
    entry = F.struct("pos", F.struct("ID", "Name", "URL", "Phases").alias("t"))
    listed = hit.groupBy("rule_id").agg(F.array_sort(F.collect_list(entry)).alias("l"))
    return listed.select("rule_id", F.transform("l", lambda x: x["t"]).alias("techniques"))


def load_rules(rules: DataFrame, techniques: DataFrame | None = None) -> list[Rule]:
    """Read the rule table (rule_id, title, kind, tags, condition) in rule_id order."""
    full = rules
    if techniques is not None:
        full = rules.join(tag_techniques(rules, techniques), "rule_id", "left")
    rows = full.collect()
    found = []
    for row in sorted(rows, key=lambda r: r["rule_id"]):
        if row["kind"] not in KINDS:
            raise ValueError(f"rule {row['rule_id']}: unknown kind {row['kind']!r}")
        named = row["techniques"] if techniques is not None else None
        found.append(
            Rule(
                row["rule_id"],
                row["title"],
                row["kind"],
                tuple(row["tags"] or ()),
                row["condition"],
                tuple(t.asDict() for t in named or ()),
            )
        )
    return found


def _table(rules: list[Rule]) -> Column:
    """All rules as one constant array; its size on the driver is one text, whatever the number of rules."""
    entries = [
        {"rule_id": r.rule_id, "title": r.title, "tags": list(r.tags), "techniques": list(r.techniques)} for r in rules
    ]
    kind = f"ARRAY<STRUCT<rule_id: STRING, title: STRING, tags: ARRAY<STRING>, techniques: ARRAY<{TECHNIQUE}>>>"
    return F.from_json(F.lit(json.dumps(entries)), kind)


def _listed(tests: list[str]) -> str:
    """The numbers that the tests give, nulls left out; compiled, as a lambda over the array would not be."""
    return f"array_except(array({', '.join(tests)}), array(cast(null as int)))"


def match_rules(
    df: DataFrame, rules: list[Rule], sysmon_rules: bool = False, indexed_from: int = INDEXED_FROM
) -> DataFrame:
    """Add ``sigma_results`` (array of matches), ``sigma_techniques`` and ``sigma_state``.

    ``sigma_state`` is match, miss or no-ruleset. Sysmon rows count as kind ``windows``, so rules
    filed under ``sysmon`` only run when ``sysmon_rules`` is set. All rules of a kind are tried; from
    ``indexed_from`` rules on, by an index of their constants, with the same result.
    """
    none = f"cast(null as array<{RESULT}>)"
    if not rules:
        return df.select(
            "*",
            F.expr(none).alias("sigma_results"),
            F.expr(f"cast(null as array<{TECHNIQUE}>)").alias("sigma_techniques"),
            F.lit(None).cast("string").alias("sigma_state"),
        )
    names: dict[tuple[str, str, str], str] = {}
    extracted: list[Column] = []

    def slot(family: str, mark: str, name: str) -> str:
        known = names.get((family, mark, name))
        if known is None:
            if name == "keywords":
                sql = "__keywords"
            else:
                sql = select_sql(family, name, bool(mark))
                if sql is None:
                    sql = "cast(null as string)"
                if mark and family in ("syslog", "snoopy"):
                    sql = f"try_cast({sql} as double)"
            known = f"__f{len(names)}"
            names[family, mark, name] = known
            wanted = "kind IN ('windows', 'sysmon')" if family == "windows" else f"kind = '{family}'"
            extracted.append(F.expr(f"CASE WHEN {wanted} THEN {sql} END").alias(known))
        return known

    tests, used, kinds, index = [], [], set(), RuleIndex()
    for rule in rules:
        family = "windows" if rule.kind == "sysmon" else rule.kind
        condition = PLACEHOLDER.sub(lambda m: slot(family, m[1], m[2]), rule.condition)
        if rule.kind == "sysmon":
            if not sysmon_rules:
                continue
            guard = "kind = 'sysmon'"
        elif rule.kind == "windows":
            guard = "kind IN ('windows', 'sysmon')"
        else:
            guard = f"kind = '{rule.kind}'"
        kinds.add(rule.kind)
        if len(rules) >= indexed_from:
            atoms, rest = split_condition(rule.condition)
            named = [(slot(family, "#" if a.number else "", a.name), a) for a in atoms]
            rest = PLACEHOLDER.sub(lambda m: slot(family, m[1], m[2]), rest)
            index.add(named, f"{guard} AND coalesce(({rest}), false)" if rest else guard)
        else:
            tests.append(f"CASE WHEN {guard} AND coalesce(({condition}), false) THEN {len(used)} END")
        used.append(rule)

    has_rules = F.col("kind").isin(*kinds) if kinds else F.lit(False)
    if "windows" in kinds:
        has_rules = has_rules | (F.col("kind") == "sysmon")
    out = with_fields(df, [keywords().alias("__keywords")])
    if extracted:
        out = with_fields(out, extracted)
    # numbers of the rules that match, or of the rests that hold: one text for each chunk, so the driver builds few expressions
    tests = tests or index.rest_tests()
    chunks = [F.expr(_listed(tests[i : i + CHUNK])).alias(f"__h{i // CHUNK}") for i in range(0, len(tests), CHUNK)]
    found = F.concat(*[F.col(f"__h{i}") for i in range(len(chunks))]) if chunks else F.array().cast("array<int>")
    none = F.array().cast("array<int>")
    if index.needs:
        out = with_fields(out, chunks)
        out = with_fields(out, [found.alias("__rests")], out.columns[: -len(chunks)])
        listed = tuple(c for (_, _, name), c in names.items() if name == "keywords")
        out = matches(out, index, "__rests", "__found", listed)
        out = with_fields(out, [F.coalesce("__found", none).alias("__numbers"), has_rules.alias("__has")], df.columns)
        numbers = F.col("__numbers")
    else:
        out = with_fields(out, [*chunks, has_rules.alias("__has")], df.columns)
        numbers = found
    out = with_fields(out, [F.when(F.col("__has"), numbers).alias("__hits")], [*df.columns, "__has"])
    table = _table(used)
    rule_of = lambda i: F.get(table, i)
    results = F.transform(
        "__hits", lambda i: F.struct(rule_of(i)["rule_id"].alias("rule_id"), rule_of(i)["title"].alias("title"), rule_of(i)["tags"].alias("tags"))
    )
    named = F.flatten(F.transform("__hits", lambda i: rule_of(i)["techniques"]))
    out = with_fields(out, [results.alias("sigma_results"), named.alias("sigma_techniques")], [*df.columns, "__has"])
    matched = F.size("sigma_results") > 0
    return out.select(
        *df.columns,
        F.when(matched, F.col("sigma_results")).alias("sigma_results"),
        F.when(F.size("sigma_techniques") > 0, F.col("sigma_techniques")).alias("sigma_techniques"),
        F.when(~F.col("__has"), "no-ruleset").when(matched, "match").otherwise("miss").alias("sigma_state"),
    )
