"""JSON schemas compiled to column expressions: what is wrong with a document, and where, as an array of strings.

A schema is data: a dictionary of the usual keywords. It is compiled once, to one expression over a variant, so a check is part of
the plan that reads the documents. A keyword that isn't known is an error when it is compiled, never passed over.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

ANNOTATIONS = {"$schema", "$id", "$comment", "title", "description", "default", "examples", "format"}


def _text(value: object) -> str:
    return json.dumps(value, ensure_ascii=False, sort_keys=True, separators=(",", ":"))


def once(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of ``value``, which is computed once for each row however often the body names it. What stands under a condition is
    otherwise computed again wherever it is named, and makes code too long to be compiled."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _number(v: Column) -> Column:
    return F.try_variant_get(v, "$", "double")


#: Whether a variant, given with the name of its type, is of a kind.
_TYPES: dict[str, Callable[[Column, Column], Column]] = {
    "string": lambda v, t: t == "STRING",
    "null": lambda v, t: t == "VOID",
    "boolean": lambda v, t: t == "BOOLEAN",
    "object": lambda v, t: t.startswith("OBJECT"),
    "array": lambda v, t: t.startswith("ARRAY"),
    "number": lambda v, t: t.rlike("^(BIGINT|DECIMAL|DOUBLE|FLOAT)"),
    "integer": lambda v, t: (t == "BIGINT") | (t.rlike("^(DECIMAL|DOUBLE|FLOAT)") & (_number(v) == F.floor(_number(v)))),
}
_string = lambda v: F.try_variant_get(v, "$", "string")
_items = lambda v: F.try_variant_get(v, "$", "array<variant>")
_fields = lambda v: F.try_variant_get(v, "$", "map<string,variant>")


def _field(v: Column, name: str) -> Column:
    escaped = name.replace("\\", "\\\\").replace("'", "\\'")
    return F.try_variant_get(v, f"$['{escaped}']", "variant")


def _only(kind: str, v: Column, t: Column, bad: Column) -> Column:
    """A rule that holds for values of one type alone."""
    return _TYPES[kind](v, t) & F.coalesce(bad, F.lit(False))


def _none() -> Column:
    return F.array().cast("array<string>")


def _all(parts: list[Column]) -> Column:
    return F.concat(*parts) if len(parts) > 1 else parts[0] if parts else _none()


def _compiled(schema: Mapping | bool, v: Column, path: Column) -> Column:
    """Reasons against ``v``, a variant that isn't SQL null."""
    if isinstance(schema, bool):
        return _none() if schema else F.array(F.concat(path, F.lit(": not allowed")))
    return once(F.schema_of_variant(v), lambda t: _typed(schema, v, t, path))


def _typed(schema: Mapping, v: Column, t: Column, path: Column) -> Column:
    """Reasons against ``v``, a variant of the type ``t``."""
    simple: list[tuple[Column, str]] = []
    nested: list[Column] = []
    for key, want in schema.items():
        if key == "type":
            kinds = [want] if isinstance(want, str) else want
            fits = F.lit(False)
            for k in kinds:
                fits = fits | _TYPES[k](v, t)
            simple.append((~fits, f"not of type {' or '.join(kinds)}"))
        elif key == "const":
            simple.append((F.to_json(v) != _text(want), f"not {_text(want)}"))
        elif key == "enum":
            simple.append((~F.to_json(v).isin([_text(x) for x in want]), "not one of the values"))
        elif key == "pattern":
            simple.append((_only("string", v, t, ~_string(v).rlike(want)), "does not match the pattern"))
        elif key in ("minLength", "maxLength"):
            n = F.char_length(_string(v))
            simple.append((_only("string", v, t, n < want if key == "minLength" else n > want), f"too {'short' if key == 'minLength' else 'long'}"))
        elif key in ("minimum", "maximum", "exclusiveMinimum", "exclusiveMaximum"):
            x = _number(v)
            bad = {"minimum": x < want, "maximum": x > want, "exclusiveMinimum": x <= want, "exclusiveMaximum": x >= want}[key]
            simple.append((_only("number", v, t, bad), f"breaks {key} {want}"))
        elif key in ("minItems", "maxItems"):
            n = F.size(_items(v))
            simple.append((_only("array", v, t, n < want if key == "minItems" else n > want), f"too {'few' if key == 'minItems' else 'many'} items"))
        elif key == "uniqueItems":
            repeat = once(F.transform(_items(v), lambda x: F.to_json(x)), lambda each: F.size(F.array_distinct(each)) < F.size(each))
            simple.append((_only("array", v, t, repeat & F.lit(bool(want))), "items repeat"))
        elif key in ("minProperties", "maxProperties"):
            n = F.size(_fields(v))
            simple.append((_only("object", v, t, n < want if key == "minProperties" else n > want), f"too {'few' if key == 'minProperties' else 'many'} fields"))
        elif key == "required":
            for name in want:
                simple.append((_only("object", v, t, _field(v, name).isNull()), f"lacks {name}"))
        elif key == "properties":
            for name, inner in want.items():
                nested.append(_present(_field(v, name), inner, F.concat(path, F.lit(f".{name}"))))
        elif key == "items":
            each = F.transform(_items(v), lambda x, i: _compiled(want, x, F.concat(path, F.lit("["), i.cast("string"), F.lit("]"))))
            nested.append(F.when(_TYPES["array"](v, t), F.flatten(each)).otherwise(_none()))
        elif key in ("additionalProperties", "propertyNames"):
            known = list(schema.get("properties", {})) if key == "additionalProperties" else []
            some = F.filter(F.map_entries(_fields(v)), lambda e: ~e["key"].isin(known) if known else F.lit(True))
            what = (lambda e: e["value"]) if key == "additionalProperties" else (lambda e: F.parse_json(F.regexp_extract(F.to_json(F.struct(e["key"].alias("k"))), r'^\{"k":(.*)\}$', 1)))
            each = F.transform(some, lambda e: _compiled(want, what(e), F.concat(path, F.lit("."), e["key"])))
            nested.append(F.when(_TYPES["object"](v, t), F.flatten(each)).otherwise(_none()))
        elif key in ("anyOf", "oneOf", "allOf"):
            holds = [F.when(F.size(_compiled(s, v, path)) == 0, 1).otherwise(0) for s in want]
            n = holds[0]
            for h in holds[1:]:
                n = n + h
            if key == "allOf":
                nested += [_compiled(s, v, path) for s in want]
            else:
                simple.append((n == 0 if key == "anyOf" else n != 1, f"fits {'none' if key == 'anyOf' else 'not one'} of {key}"))
        elif key == "not":
            simple.append((F.size(_compiled(want, v, path)) == 0, "fits what it must not"))
        elif key not in ANNOTATIONS:
            raise ValueError(f"the keyword {key} isn't known")
    found = F.filter(F.array(*[F.when(bad, F.concat(path, F.lit(f": {why}"))) for bad, why in simple]), lambda x: x.isNotNull()) if simple else None
    return _all([x for x in (found, *nested) if x is not None])


def _present(v: Column, schema: Mapping | bool, path: Column) -> Column:
    return once(v, lambda x: F.when(x.isNull(), _none()).otherwise(_compiled(schema, x, path)))


def violations(document: Column, schema: Mapping) -> Column:
    """Sorted reasons, each with its path, why a JSON text does not fit ``schema``; an empty array if it does. Text that is null or no
    JSON has the one reason ``$: not JSON``."""
    found = lambda v: F.when(v.isNull(), F.array(F.lit("$: not JSON"))).otherwise(F.array_sort(_compiled(schema, v, F.lit("$"))))
    return once(F.try_parse_json(document), found)


def with_fields(document: Column, fields: Mapping[str, Column]) -> Column:
    """A JSON object's canonical text with fields set, each to a JSON text."""
    kept = F.map_filter(F.from_json(document, "map<string,variant>"), lambda k, _: ~k.isin(list(fields)))
    new = F.create_map(*[x for k, t in fields.items() for x in (F.lit(k), F.parse_json(t))])
    return F.to_json(F.parse_json(F.to_json(F.map_concat(kept, new))))


# Fixed values of the record and event formats.
_TEXT, _OPTIONAL, _LIST = {"type": "string"}, {"type": ["string", "null"]}, {"type": "array"}
_HASH = {"type": "string", "pattern": "^[a-f0-9]{64}$"}
RECORD = {
    "type": "object",
    "required": ["schema_version", "record_id", "kind", "source_id", "native_id", "aliases", "status", "title", "published_at", "source_modified_at", "first_seen_at", "affected", "references", "provenance", "content_hash"],
    "properties": {
        "schema_version": {"const": "1.0"}, "record_id": _TEXT | {"minLength": 3}, "kind": {"enum": ["advisory", "poc", "resource", "continuation"]},
        "source_id": _TEXT, "native_id": _TEXT, "aliases": {"type": "array", "items": _TEXT, "uniqueItems": True}, "status": _TEXT, "title": _OPTIONAL,
        "published_at": _OPTIONAL, "source_modified_at": _OPTIONAL, "first_seen_at": _TEXT, "affected": _LIST, "references": _LIST, "provenance": _LIST, "content_hash": _HASH,
    },
}
EVENT = {
    "type": "object",
    "required": ["schema_version", "event_id", "record_id", "event_type", "previous_hash", "content_hash", "source_revision", "source_occurred_at", "observed_at", "policy_version"],
    "properties": {
        "schema_version": {"const": "1.0"}, "event_id": _HASH, "record_id": _TEXT,
        "event_type": {"enum": [
            "disclosure", "kev_added", "kev_removed", "affected_corrected", "score_changed", "withdrawn", "rejected", "poc_added", "poc_changed", "template_added",
            "template_logic_changed", "template_requirements_changed", "source_deleted", "retention_removed",
        ]},
        "previous_hash": _OPTIONAL, "content_hash": _OPTIONAL, "source_revision": _OPTIONAL, "source_occurred_at": _OPTIONAL, "observed_at": _TEXT, "policy_version": _TEXT,
    },
}
