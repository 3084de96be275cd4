"""The rule index: what it reads out of conditions, and the same matches with and without it."""

from __future__ import annotations

import pytest

from logspark.operators.decode import decode
from logspark.operators.rule_index import Atom, RuleIndex, conjuncts, split_condition
from logspark.operators.rules import load_rules, match_rules
from logspark.plans import render
from logspark.plans.q_enrich import RULE_ROWS, many_rules, rules_table

SMALL = "/root/testdata/sf0.001"


@pytest.mark.parametrize(
    ("condition", "parts"),
    [
        ("{a} = 'x' AND {b} = 'y'", ["{a} = 'x'", "{b} = 'y'"]),
        ("({a} = 'x') and ( ({b} = 'y') )", ["{a} = 'x'", "{b} = 'y'"]),
        ("({a} = 'x' OR {b} = 'y') AND {c} = 'z'", ["{a} = 'x' OR {b} = 'y'", "{c} = 'z'"]),
        ("({a}) = ({b})", ["({a}) = ({b})"]),
        ("{a} = ' AND ' AND {b} = ') OR ('", ["{a} = ' AND '", "{b} = ') OR ('"]),
        ("{a} = 'x' OR {b} = 'y' AND {c} = 'z'", []),
        ("CASE WHEN {a} = 'x' AND {b} = 'y' THEN true END", []),
        ("{a} = 'x' -- AND", []),
        ("{a} = 'x' AND ({b} = 'y'", []),
        ("{a} = 'x' | {b}", []),
    ],
)
def test_conjuncts_of_the_top_level(condition, parts):
    assert conjuncts(condition) == parts


@pytest.mark.parametrize(
    ("condition", "atoms", "rest"),
    [
        ("{a.b} = 'x'", [Atom("a.b", False, True, ("x",))], ""),
        ("{#id} = 4624 AND {#id} > 5", [Atom("id", True, True, (4624.0,))], "({#id} > 5)"),
        ("{a} IN ('x', 'y') AND NOT {a} = 'y'", [Atom("a", False, True, ("x", "y"))], "(NOT {a} = 'y')"),
        ("{#id} in (1, -2.5)", [Atom("id", True, True, (1.0, -2.5))], ""),
        ("{a} LIKE '%abc%'", [Atom("a", False, False, ("abc",))], ""),
        ("{a} LIKE 'abc%de'", [Atom("a", False, False, ("abc",), False)], "({a} LIKE 'abc%de')"),
        ("contains({a}, 'abc') AND startswith({b}, 'def')",
         [Atom("a", False, False, ("abc",)), Atom("b", False, False, ("def",), False)], "(startswith({b}, 'def'))"),
        ("exists({keywords}, w -> contains(w, 'GET'))", [Atom("keywords", False, False, ("GET",))], ""),
        # no atoms: too short, a cast, an escape, a mixed list, another variable, an alternative
        ("{a} LIKE '%ab%'", [], "({a} LIKE '%ab%')"),
        ("{a} = 5", [], "({a} = 5)"),
        ("{#a} = '5'", [], "({#a} = '5')"),
        (r"{a} = 'x\'y'", [], r"({a} = 'x\'y')"),
        ("{a} LIKE '%a!%bc%' ESCAPE '!'", [], "({a} LIKE '%a!%bc%' ESCAPE '!')"),
        ("{a} IN ('x', 5)", [], "({a} IN ('x', 5))"),
        ("{keywords} = 'x'", [], "({keywords} = 'x')"),
        ("exists({keywords}, w -> contains(v, 'GET'))", [], "(exists({keywords}, w -> contains(v, 'GET')))"),
        ("{a} = 'x' OR {a} = 'y'", [], "({a} = 'x' OR {a} = 'y')"),
        ("{a} BETWEEN 'b' AND 'c' AND {b} = 'x'", [], "({a} BETWEEN 'b' AND 'c' AND {b} = 'x')"),
    ],
)
def test_atoms_and_rests(condition, atoms, rest):
    assert split_condition(condition) == (atoms, rest)


ODD = [
    ("s1", "sysmon", "sysmon", [], "{winlog.task} = 'Task 1' AND {process.name} LIKE 'proc%'"),
    ("s2", "any windows", "windows", ["attack.t1009"], "true"),
    ("s3", "null", "suricata", [], "null AND {host} = 'host-1'"),
    ("s4", "between", "windows", [], "{#winlog.event_id} BETWEEN 4600 AND 4650 AND {process.name} IN ('proc1.exe', 'proc3.exe')"),
    ("s5", "either", "snoopy", [], "({cmd} LIKE '%cmd5%' OR {cmd} LIKE '%cmd6%') AND contains({login}, 'user1')"),
    ("s6", "same twice", "snoopy", [], "{cmd} LIKE '%cmd5%' AND {cmd} LIKE '%cmd5%'"),
    ("s7", "overlapping", "snoopy", [], "{filename} LIKE '%/bin/cmd%' AND {filename} LIKE '%cmd7%' AND {cwd} = '/root'"),
    ("s8", "syslog", "syslog", [], "{#severity} = 5 AND {message} LIKE '%value%'"),
    ("s9", "ends", "snoopy", [], "endswith({filename}, 'cmd3') AND NOT contains({cmd}, '11')"),
    ("t1", "words", "suricata", [], "exists({keywords}, w -> startswith(w, 'GET /1')) AND exists({keywords}, v -> contains(v, 'Category'))"),
]


@pytest.mark.parametrize("sysmon", [False, True])
def test_matches_are_the_same_with_and_without_the_index(spark, sysmon):
    events = decode(render.json_events(spark, SMALL)).cache()
    rules = load_rules(spark.createDataFrame(RULE_ROWS + ODD + many_rules(120), rules_table(spark).schema))
    columns = ["offset", "sigma_results", "sigma_techniques", "sigma_state"]
    found = [
        sorted(match_rules(events, rules, sysmon, indexed_from=n).select(*columns).collect(), key=lambda r: r["offset"])
        for n in (1, len(rules) + 1)
    ]
    assert found[0] == found[1]
    assert {r["rule_id"] for row in found[0] for r in row["sigma_results"] or ()} >= {"r01", "r02", "s2", "s4", "s5", "s6", "s7", "s9", "t1"}


def test_rules_do_not_add_stages_or_shuffles(spark):
    rules = load_rules(spark.createDataFrame(many_rules(500), rules_table(spark).schema))
    plan = match_rules(decode(render.json_events(spark, SMALL)), rules)._jdf.queryExecution().executedPlan().toString()
    # the events are rendered from a table; nothing else is exchanged
    assert plan.count("ArrowEvalPython") == 1 and "BroadcastExchange" not in plan.split("ArrowEvalPython")[0]


def test_a_rule_is_looked_at_for_what_few_rules_share():
    index = RuleIndex()
    for *_, condition in many_rules(2000):
        atoms, rest = split_condition(condition)
        index.add([(a.name, a) for a in atoms], rest)
    # hundreds of them name the user root, or a host by how it begins
    assert sorted(n for rules in index.rules.values() for n in rules) == list(range(2000))
    assert max(map(len, index.rules.values())) <= 2
