"""An inverted index over detection rules: which rules match an event, without trying each of them.

A condition whose top level is a list of conjuncts matches if each of them does. Conjuncts that compare a field with
constants are atoms: an equality goes into a table from value to atoms, a substring into one automaton per field that
finds the constants of all rules in one walk over the text. What else a condition says is its rest, a SQL text that is
evaluated once per event, however many rules share it. A rule is looked at only for events that hold one of its atoms, the
one that the fewest rules have, and matches if its other atoms and its rest hold too.
"""

from __future__ import annotations

import re
from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass, field

import ahocorasick
import pandas as pd
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.functions import pandas_udf

# The shortest substring worth an automaton: shorter ones are in most texts.
LEAST_TEXT = 3
# Separates the parts of a field that is a list; a constant that holds it makes no atom.
PARTED = "\0"

_FIELD = r"\{(?P<mark>#?)(?P<name>[@\w.\-/ ]+)\}"
_TEXT = r"'(?P<text>[^'\\]*)'"
_EQUAL = re.compile(rf"{_FIELD}\s*(?:=|==)\s*(?:{_TEXT}|(?P<number>-?\d+(?:\.\d+)?))")
_AMONG = re.compile(rf"{_FIELD}\s+IN\s*\((?P<list>[^()]*)\)", re.I)
_LIKE = re.compile(rf"{_FIELD}\s+LIKE\s+{_TEXT}", re.I)
_CALL = re.compile(rf"(?P<call>contains|startswith|endswith)\s*\(\s*{_FIELD}\s*,\s*{_TEXT}\s*\)", re.I)
_SOME = re.compile(
    r"exists\s*\(\s*\{keywords\}\s*,\s*(?P<var>\w+)\s*->\s*(?P<call>contains|startswith|endswith)\s*\(\s*(?P=var)\s*,\s*" + _TEXT + r"\s*\)\s*\)",
    re.I,
)
_ITEM = re.compile(rf"\s*(?:{_TEXT}|(?P<number>-?\d+(?:\.\d+)?))\s*(?:,|\Z)")
_TOKEN = re.compile(r"'(?:[^'\\]|\\.)*'|\"(?:[^\"\\]|\\.)*\"|`[^`]*`|\{[^}]*\}|\w+|\s+|.", re.S)
# words at the top level that make a conjunct not stand for itself
_LOOSE = frozenset("or case when then else end xor between".split())


@dataclass(frozen=True)
class Atom:
    """A field that equals one of the constants, or contains the only one."""

    name: str
    number: bool
    equal: bool
    values: tuple[str | float, ...]
    # whether the conjunct says no more than this
    whole: bool = True


def conjuncts(condition: str) -> list[str]:
    """The parts of a condition between the ANDs of its top level; nothing when it holds an alternative there.

    A BETWEEN, whose AND is another, and comments are not taken apart.
    """
    if "--" in condition or "/*" in condition:
        return []
    parts, depth = [""], 0
    for token in _TOKEN.findall(condition):
        word = token.lower()
        depth += token in ("(", "[")
        depth -= token in (")", "]")
        if depth == 0 and word in _LOOSE:
            return []
        if depth == 0 and token in ("|", "&"):
            return []
        if depth == 0 and word == "and":
            parts.append("")
        else:
            parts[-1] += token
    return [] if depth else [bare(p) for p in parts]


def bare(part: str) -> str:
    """Without blanks and outer parentheses around the whole."""
    part = part.strip()
    while part.startswith("(") and part.endswith(")"):
        depth = 0
        for i, token in enumerate(tokens := _TOKEN.findall(part)):
            depth += (token == "(") - (token == ")")
            if depth == 0 and i < len(tokens) - 1:
                return part
        part = part[1:-1].strip()
    return part


def atom_of(conjunct: str) -> Atom | None:
    """The comparison with constants that a conjunct is or implies, if any."""
    if found := _EQUAL.fullmatch(conjunct):
        return _equal(found, [(found["text"], found["number"])])
    if found := _AMONG.fullmatch(conjunct):
        items, at = [], 0
        while at < len(found["list"]):
            item = _ITEM.match(found["list"], at)
            if not item:
                return None
            items.append((item["text"], item["number"]))
            at = item.end()
        return _equal(found, items) if items else None
    if found := _LIKE.fullmatch(conjunct):
        text = max(re.split("[%_]", found["text"]), key=len)
        return _inside(found["mark"], found["name"], text, found["text"] == f"%{text}%")
    if found := _CALL.fullmatch(conjunct):
        return _inside(found["mark"], found["name"], found["text"], found["call"].lower() == "contains")
    if found := _SOME.fullmatch(conjunct):
        return _inside("", "keywords", found["text"], found["call"].lower() == "contains")
    return None


def _equal(found: re.Match, items: list[tuple[str | None, str | None]]) -> Atom | None:
    """Only comparisons of one kind: text with text, numbers with numbers, so that no cast is involved."""
    if found["name"] == "keywords":
        return None
    if found["mark"]:
        if all(number is not None and len(number) <= 15 for _, number in items):
            return Atom(found["name"], True, True, tuple(float(n) for _, n in items))
        return None
    return Atom(found["name"], False, True, tuple(t for t, _ in items)) if all(t is not None for t, _ in items) else None


def _inside(mark: str, name: str, text: str, whole: bool) -> Atom | None:
    known = not mark and len(text) >= LEAST_TEXT and PARTED not in text
    return Atom(name, False, False, (text,), whole) if known else None


def split_condition(condition: str) -> tuple[list[Atom], str]:
    """The atoms that a condition implies, and what it says besides, as SQL text with its placeholders ("" if nothing).

    The rest keeps its conjuncts in their order, but no longer stands behind the atoms: a condition must not rely on
    an atom to keep a cast from failing.
    """
    atoms, rest = [], []
    parts = conjuncts(condition)
    for part in parts or [condition]:
        atom = atom_of(part) if parts else None
        if atom:
            atoms.append(atom)
        if not (atom and atom.whole):
            rest.append(f"({part})")
    return atoms, " AND ".join(rest)


# What a rule may be looked at for; its rest only if it has no atom.
EQUAL, INSIDE, REST = range(3)


@dataclass
class RuleIndex:
    """Numbered atoms and rests, where to find them, and what each rule needs."""

    numbers: dict[tuple, int] = field(default_factory=dict)
    equal: dict[str, dict[str | float, list[int]]] = field(default_factory=lambda: defaultdict(lambda: defaultdict(list)))
    inside: dict[str, dict[str, list[int]]] = field(default_factory=lambda: defaultdict(lambda: defaultdict(list)))
    rests: list[str] = field(default_factory=list)
    kinds: dict[int, int] = field(default_factory=dict)
    needs: list[frozenset[int]] = field(default_factory=list)

    def add(self, atoms: list[tuple[str, Atom]], rest: str) -> None:
        """The next rule: its atoms with the column that each is about, and its rest, now about columns too."""
        kinds = {self._rest(rest): REST}
        for slot, atom in atoms:
            kinds[self._atom(slot, atom)] = EQUAL if atom.equal else INSIDE
        self.kinds.update(kinds)
        self.needs.append(frozenset(kinds))

    @property
    def rules(self) -> dict[int, list[int]]:
        """For an atom or rest: the rules that are looked at when it holds.

        An atom that many rules have, as a common user name, would have all of them looked at for every event that
        holds it, so a rule goes to the one of its atoms that the fewest have.
        """
        shared = Counter(n for need in self.needs for n in need)
        found = defaultdict(list)
        for rule, need in enumerate(self.needs):
            found[min(need, key=lambda n: (self.kinds[n] == REST, shared[n], self.kinds[n], n))].append(rule)
        return dict(found)

    def _atom(self, slot: str, atom: Atom) -> int:
        key = (slot, atom.equal, atom.values)
        if key not in self.numbers:
            self.numbers[key] = len(self.numbers)
            for value in dict.fromkeys(atom.values):
                (self.equal if atom.equal else self.inside)[slot][value].append(self.numbers[key])
        return self.numbers[key]

    def _rest(self, rest: str) -> int:
        if ("", rest) not in self.numbers:
            self.numbers["", rest] = len(self.numbers)
            self.rests.append(rest)
        return self.numbers["", rest]

    def rest_tests(self) -> list[str]:
        """SQL texts that give the number of each rest that holds, else null."""
        return [f"CASE WHEN {rest} THEN {self.numbers['', rest]} END" for rest in self.rests]


def _matcher(equal: list[dict], inside: list[dict], rules: dict[int, list[int]], needs: list[frozenset[int]]):
    """Numbers of the matching rules; columns: the rests that hold, then those of ``equal``, then those of ``inside``."""

    @pandas_udf("array<int>")
    def match(batches: Iterator[tuple[pd.Series, ...]]) -> Iterator[pd.Series]:
        automata = []
        for table in inside:
            automaton = ahocorasick.Automaton()
            for constant, atoms in table.items():
                automaton.add_word(constant, atoms)
            automaton.make_automaton()
            automata.append(automaton)
        for rests, *columns in batches:
            held = [set(r.tolist()) if r is not None else set() for r in rests]
            for table, values in zip(equal, columns):
                for own, value in zip(held, values):
                    if atoms := table.get(value):
                        own.update(atoms)
            for automaton, texts in zip(automata, columns[len(equal) :]):
                for own, text in zip(held, texts):
                    if text is not None:
                        for _, atoms in automaton.iter(text):
                            own.update(atoms)
            hits = [sorted(n for atom in own for n in rules.get(atom, ()) if needs[n] <= own) for own in held]
            yield pd.Series([h or None for h in hits], dtype=object)

    return match


def matches(df: DataFrame, index: RuleIndex, rests: str, out: str, listed: tuple[str, ...] = ()) -> DataFrame:
    """Add ``out``: the ascending numbers of the matching rules; null: none. ``rests`` is the column of held rests.

    One Arrow-batched look-up for all columns, so events are not shuffled and the plan stays one stage. The index
    travels with the function; it is no larger than the rule table, which the driver has read. ``listed`` columns are
    arrays of text.
    """
    equal, inside = sorted(index.equal.items()), sorted(index.inside.items())
    columns = [F.col(slot) for slot, _ in equal]
    columns += [F.array_join(slot, PARTED) if slot in listed else F.col(slot) for slot, _ in inside]
    match = _matcher([dict(t) for _, t in equal], [dict(t) for _, t in inside], index.rules, index.needs)
    return df.withColumn(out, match(F.col(rests), *columns))
