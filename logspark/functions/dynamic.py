"""Typed access to schemaless JSON held as VARIANT.

Paths are dotted. Two rules differ from ``try_variant_get``:

* a value counts as a string only when JSON says so; numbers are not coerced;
* when a walk meets a non-object before the path ends, that value is the answer
  (``strict=True`` turns this off).

The helpers return SQL text so that detection rules can use them too; the ``*_col``
forms wrap them as Columns.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

NUMBER_TYPES = ("BIGINT", "DOUBLE", "FLOAT")


def json_path(parts: list[str]) -> str:
    for part in parts:
        if not part or any(c in part for c in "\"'\\[]"):
            raise ValueError(f"unsupported path part: {part!r}")
    return "$" + "".join(f'["{p}"]' for p in parts)


def _get(v: str, parts: list[str], kind: str = "variant") -> str:
    return f"try_variant_get({v}, '{json_path(parts)}', '{kind}')"


def _prefixes(path: str, strict: bool) -> list[list[str]]:
    parts = path.split(".")
    return [parts] if strict else [parts[:n] for n in range(len(parts), 0, -1)]


def string_sql(v: str, path: str, strict: bool = False) -> str:
    """JSON string at ``path``, else null.

    Of all JSON values only a string casts to BINARY, so one look tells its type and gives its text; asking for the
    type by ``schema_of_variant`` copies the value into a VARIANT of its own first.
    """
    options = [f"cast({_get(v, p, 'binary')} as string)" for p in _prefixes(path, strict)]
    return options[0] if len(options) == 1 else "coalesce(" + ", ".join(options) + ")"


def number_sql(v: str, path: str, strict: bool = False) -> str:
    """JSON number at ``path`` as DOUBLE, else null."""
    kinds = ", ".join(f"'{t}'" for t in NUMBER_TYPES)
    options = [
        f"CASE WHEN schema_of_variant({_get(v, p)}) IN ({kinds}) "
        f"OR schema_of_variant({_get(v, p)}) LIKE 'DECIMAL%' THEN {_get(v, p, 'double')} END"
        for p in _prefixes(path, strict)
    ]
    return options[0] if len(options) == 1 else "coalesce(" + ", ".join(options) + ")"


def text_sql(v: str, path: str, strict: bool = False) -> str:
    """Any value at ``path`` printed as text (objects and arrays as JSON)."""
    head, *rest = _prefixes(path, strict)
    options = [_get(v, head, "string")] + [
        f"CASE WHEN NOT startswith(schema_of_variant({_get(v, p)}), 'OBJECT') THEN {_get(v, p, 'string')} END"
        for p in rest
    ]
    return options[0] if len(options) == 1 else "coalesce(" + ", ".join(options) + ")"


def variant_sql(v: str, path: str, strict: bool = False) -> str:
    """The VARIANT at ``path``."""
    head, *rest = _prefixes(path, strict)
    options = [_get(v, head)] + [
        f"CASE WHEN NOT startswith(schema_of_variant({_get(v, p)}), 'OBJECT') THEN {_get(v, p)} END"
        for p in rest
    ]
    return options[0] if len(options) == 1 else "coalesce(" + ", ".join(options) + ")"


def dot_string(v: str, path: str, strict: bool = False) -> Column:
    return F.expr(string_sql(v, path, strict))


def dot_number(v: str, path: str, strict: bool = False) -> Column:
    return F.expr(number_sql(v, path, strict))


def dot_text(v: str, path: str, strict: bool = False) -> Column:
    return F.expr(text_sql(v, path, strict))


def dot_field(v: str, path: str, strict: bool = False) -> Column:
    return F.expr(variant_sql(v, path, strict))


def parse_object(raw: str) -> Column:
    """VARIANT of a JSON object; null for broken text and for other JSON values."""
    return F.expr(f"CASE WHEN startswith(ltrim({raw}), '{{') THEN try_parse_json({raw}) END")
