"""Contracts given as JSON Schema, compiled to column expressions.

The keywords are ``type``, ``required``, ``properties``, ``additionalProperties`` (true or false), and per property ``type``,
``pattern``, ``minLength``, ``maxLength``, ``minimum``, ``maximum``, ``exclusiveMinimum``, ``exclusiveMaximum``, ``const`` and
``enum``; anything else that would restrict a record is refused. A rule is a name like ``volume:minimum`` and a condition
that is true where a record breaks it. Compiled once, the rules of a contract are one projection without any Python.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Keywords that only describe.
NOTES = {"$schema", "$id", "title", "description", "default", "examples", "$comment"}
_OBJECT = {"type", "required", "properties", "additionalProperties"}
_NAMES = {
    "pattern": "pattern", "minLength": "min_length", "maxLength": "max_length", "minimum": "minimum", "maximum": "maximum",
    "exclusiveMinimum": "exclusive_minimum", "exclusiveMaximum": "exclusive_maximum", "const": "const", "enum": "enum",
}

#: What a contract finds fault with where a message is no JSON object at all.
NOT_AN_OBJECT = "record:type"

Rules = list[tuple[str, Column]]


def _checked(schema: dict) -> dict[str, dict]:
    """The properties, once every keyword is known."""
    unknown = set(schema) - NOTES - _OBJECT
    for name, spec in schema.get("properties", {}).items():
        unknown |= {f"{name}.{k}" for k in set(spec) - NOTES - set(_NAMES) - {"type"}}
    if unknown:
        raise ValueError(f"keywords that aren't handled: {sorted(unknown)}")
    if schema.get("type", "object") != "object":
        raise ValueError("a contract describes objects")
    return schema.get("properties", {})


def _types(spec: dict) -> list[str]:
    kinds = spec.get("type", [])
    return [kinds] if isinstance(kinds, str) else list(kinds)


def _same(is_text: Column, number: Column, text: Column, wanted) -> Column:
    """Whether a value is the given string, number or truth value; numbers are equal as numbers."""
    if isinstance(wanted, bool):
        return ~is_text & text.eqNullSafe(F.lit(str(wanted).lower()))
    if isinstance(wanted, (int, float)):
        return number.eqNullSafe(F.lit(float(wanted)))
    if isinstance(wanted, str):
        return is_text & text.eqNullSafe(F.lit(wanted))
    raise ValueError(f"{wanted!r}: only strings, numbers and truth values can be compared")


def _broken(spec: dict, is_text: Column, is_number: Column, number: Column, text: Column) -> dict[str, Column]:
    """Conditions by keyword. As JSON Schema has it, a keyword for strings or numbers says nothing about other values."""
    tests = {
        "pattern": lambda v: is_text & ~text.rlike(v),
        "minLength": lambda v: is_text & (F.char_length(text) < v),
        "maxLength": lambda v: is_text & (F.char_length(text) > v),
        "minimum": lambda v: is_number & (number < v),
        "maximum": lambda v: is_number & (number > v),
        "exclusiveMinimum": lambda v: is_number & (number <= v),
        "exclusiveMaximum": lambda v: is_number & (number >= v),
        "const": lambda v: ~_same(is_text, number, text, v),
        "enum": lambda v: ~_any([_same(is_text, number, text, w) for w in v]),
    }
    return {_NAMES[k]: tests[k](spec[k]) for k in _NAMES if k in spec}


def _any(conditions: list[Column]) -> Column:
    out = F.lit(False)
    for condition in conditions:
        out = out | condition
    return out


def row_rules(schema: dict, rows: DataFrame) -> Rules:
    """Rules for typed rows, whose columns stand for the properties. A null counts as absent, and columns have the types that
    reading gave them, so ``type`` has nothing left to say; a property without a column is absent."""
    properties = _checked(schema)
    kinds = {f.name: f.dataType.typeName() for f in rows.schema.fields}
    rules = [(f"{n}:required", F.col(n).isNull() if n in kinds else F.lit(True)) for n in schema.get("required", [])]
    for name, spec in properties.items():
        if name not in kinds:
            continue
        here = F.col(name).isNotNull()
        is_text = F.lit(kinds[name] in ("string", "varchar", "char"))
        is_number = F.lit(kinds[name] in ("byte", "short", "integer", "long", "float", "double") or kinds[name].startswith("decimal"))
        number = F.try_to_number(F.lit(None).cast("string"), F.lit("9")) if kinds[name] in ("string", "boolean") else F.col(name)
        for rule, broken in _broken(spec, is_text, is_number, number.cast("double"), F.col(name).cast("string")).items():
            rules.append((f"{name}:{rule}", here & broken))
    if schema.get("additionalProperties") is False:
        rules += [(f"{n}:additional", F.col(n).isNotNull()) for n in rows.columns if n not in properties]
    return rules


def message_rules(schema: dict, text: str = "value") -> Rules:
    """Rules for JSON texts, types included, as the schema's own validation has them."""
    properties = _checked(schema)
    raw = F.col(text).cast("string")
    record = F.try_parse_json(raw)
    whole = F.coalesce(F.schema_of_variant(record).startswith("OBJECT<"), F.lit(False))
    keys = F.json_object_keys(raw)
    rules = [(NOT_AN_OBJECT, ~whole)]
    rules += [(f"{n}:required", whole & ~F.array_contains(keys, n)) for n in schema.get("required", [])]
    for name, spec in properties.items():
        path = "$['" + name.replace("'", "\\'") + "']"
        here = whole & F.array_contains(keys, name)
        kind = F.coalesce(F.schema_of_variant(F.try_variant_get(record, path, "variant")), F.lit("VOID"))
        string, truth = kind == "STRING", kind == "BOOLEAN"
        numeric = kind.startswith("BIGINT") | kind.startswith("DECIMAL") | (kind == "DOUBLE")
        number = F.try_variant_get(record, path, "double")
        is_kind = {
            "string": string, "boolean": truth, "number": numeric, "integer": numeric & (number == F.floor(number)),
            "object": kind.startswith("OBJECT"), "array": kind.startswith("ARRAY"), "null": kind == "VOID",
        }
        if _types(spec):
            rules.append((f"{name}:type", here & ~_any([is_kind[k] for k in _types(spec)])))
        as_number = F.when(numeric, number)
        as_text = F.when(string | truth, F.try_variant_get(record, path, "string"))
        for rule, broken in _broken(spec, string, numeric, as_number, as_text).items():
            rules.append((f"{name}:{rule}", here & broken))
    if schema.get("additionalProperties") is False:
        known = F.array(*map(F.lit, properties)) if properties else F.array().cast("array<string>")
        rules.append(("record:additional", whole & (F.size(F.array_except(keys, known)) > 0)))
    return rules


def broken_rules(rules: Rules) -> Column:
    """The names of the rules that a record breaks, in the order of the contract."""
    return F.filter(F.array(*[F.when(F.coalesce(bad, F.lit(False)), F.lit(name)) for name, bad in rules]), lambda rule: rule.isNotNull())


def quarantine(rows: DataFrame, rules: Rules) -> tuple[DataFrame, DataFrame]:
    """Records that keep all rules, and the others with the rules they break as ``broken``."""
    marked = rows.withColumn("broken", broken_rules(rules))
    return marked.where(F.size("broken") == 0).drop("broken"), marked.where(F.size("broken") > 0)


def load(path: str) -> dict:
    """A contract from a file; a byte order mark does no harm."""
    with open(path, encoding="utf-8-sig") as file:
        return json.load(file)
