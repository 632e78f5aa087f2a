"""Strict reading of JSON answers as expressions: types, enumerations, required fields and nulls are checked as the answers' models do, without Python.

A value is taken where it is the field's type or plainly means one: numbers in text and whole decimals for an integer, `yes`, `off`, 1 or 0 for a flag. Anything
else is an error, as are null for a list or a flag, a missing required field, and a value that isn't of a closed domain. Unknown fields are left out.
Differences from the models, all of them errors here: a field that comes twice, an integer beyond 32 bits, NaN and infinities.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from millrace.functions.text import json_slice
from millrace.schemas import DOMAINS, EXTRACTION_FIELDS, REQUIRED_FIELDS, struct_type

# Texts that stand for a flag.
TRUE, FALSE = ("1", "on", "t", "true", "y", "yes"), ("0", "f", "false", "n", "no", "off")
WHOLE = r"(?U)\A\s*([+-]?[0-9]+(?:_[0-9]+)*)(?:\.0+)?\s*\z"
#: Half of a surrogate pair in escapes, which stands for no character.
LONE = r"(?i)(?<!\\)(?:\\\\)*(?:\\ud[89ab][0-9a-f]{2}(?!\\ud[c-f][0-9a-f]{2})|(?<!\\ud[89ab][0-9a-f]{2})\\ud[c-f][0-9a-f]{2})"
_SMALL = 2147483647.0


#: First characters of a value as JSON.
STRING, OBJECT, ARRAY, NULL, BOOL, NESTED = '"', "{", "[", "n", ("t", "f"), ("[", "{")


def _head(v: Column) -> Column:
    """The first character of a value as JSON, which shows its kind: a digit or a sign is a number's."""
    return F.substring(F.to_json(v), 1, 1)


def _once(value: Column, body: Callable[[Column], Column]) -> Column:
    """body(value) with value computed once: a variable stands for it, where it would be repeated else."""
    return F.get(F.transform(F.array(value), body), 0)


def _result(value: Column, error: Column) -> Column:
    return F.struct(value.alias("value"), error.alias("error"))


def _integer(v: Column, head: Column) -> Column:
    """Of an integer that may be null."""
    number = F.try_variant_get(v, "$", "double")
    of_number = _result(number.try_cast("int"), F.when(number != F.floor(number), "int_from_float").when(F.abs(number) > _SMALL, "int_parsing_size"))

    def of_digits(digits: Column) -> Column:
        return _result(digits.try_cast("int"), F.when(digits == "", "int_parsing").when(digits.try_cast("int").isNull(), "int_parsing_size"))

    of_text = _once(F.regexp_replace(F.regexp_extract(F.try_variant_get(v, "$", "string"), WHOLE, 1), "_", ""), of_digits)
    of_bool = _result(F.try_variant_get(v, "$", "boolean").cast("int"), _none())
    other = _result(F.lit(None).cast("int"), F.when(head != NULL, "int_type"))
    return F.when(head.isin(NULL, *NESTED), other).when(head == STRING, of_text).when(head.isin(*BOOL), of_bool).otherwise(of_number)


def _none(kind: str = "string") -> Column:
    return F.lit(None).cast(kind)


def _flag(v: Column, head: Column) -> Column:
    number, text = F.try_variant_get(v, "$", "double"), F.lower(F.try_variant_get(v, "$", "string"))
    of_number = _result(number == 1, F.when(~number.isin(0.0, 1.0), F.when(number == F.floor(number), "bool_parsing").otherwise("bool_type")))
    of_text = _result(text.isin(*TRUE), F.when(~text.isin(*TRUE, *FALSE), "bool_parsing"))
    other = _result(_none("boolean"), F.lit("bool_type"))
    return F.when(head.isin(*BOOL), _result(F.try_variant_get(v, "$", "boolean"), _none())).when(head.isin(NULL, *NESTED), other).when(head == STRING, of_text).otherwise(of_number)


def _text(v: Column, head: Column, domain: tuple[str, ...] | None, required: bool) -> Column:
    value = F.try_variant_get(v, "$", "string")
    wrong = "string_type" if domain is None else "literal_error"
    # A number beyond all doubles stands as text in JSON.
    endless = value.isin("Infinity", "-Infinity") & (F.schema_of_variant(v) != "STRING")
    of_text = _result(value, F.when(endless if domain is None else ~value.isin(*domain), wrong))
    return F.when(head == STRING, of_text).otherwise(_result(_none(), F.lit(wrong) if required else F.when(head != NULL, wrong)))


def _list(v: Column, head: Column, item: str, one: Callable[[Column], Column]) -> Column:
    """Of a list; the error is that of the first item that has one."""

    def of_items(items: Column) -> Column:
        errors = F.filter(F.transform(items, lambda x: x["error"]), lambda e: e.isNotNull())
        return _result(F.transform(items, lambda x: x["value"]), F.get(errors, 0))

    got = _once(F.transform(F.try_variant_get(v, "$", "array<variant>"), one), of_items)
    return F.when(head == ARRAY, got).otherwise(_result(_none(f"array<{item}>"), F.lit("list_type")))


def _object(v: Column, fields: tuple) -> Column:
    return F.when(_head(v) == OBJECT, checked(v, fields)).otherwise(_result(_none(struct_type(fields)), F.lit("model_type")))


def _field(v: Column, name: str, kind) -> Column:
    """struct(value, error) of a field of an object; a value may be null where there is an error."""
    required = name in REQUIRED_FIELDS
    if kind == "boolean":
        of, absent = _flag, F.lit(False)
    elif kind == "int":
        of, absent = _integer, _none("int")
    elif kind == "string":
        of, absent = (lambda x, k: _text(x, k, DOMAINS.get(name), required)), _none()
    elif kind == "array<string>":
        of, absent = (lambda x, k: _list(x, k, "string", lambda i: _text(i, _head(i), None, True))), F.array().cast("array<string>")
    else:
        item = struct_type(kind)
        of, absent = (lambda x, k: _list(x, k, item, lambda i: _object(i, kind))), F.array().cast(f"array<{item}>")
    missing = _result(absent, F.lit("missing" if required else None).cast("string"))
    return _once(F.try_variant_get(v, f"$.{name}", "variant"), lambda x: F.when(x.isNull(), missing).otherwise(of(x, _head(x))))


def checked(v: Column, fields: tuple) -> Column:
    """struct(value, error) of an object's fields, the error being the first by the order of fields; the value is null if there is one."""

    def whole(got: Column) -> Column:
        error = F.coalesce(*(got[name]["error"] for name, _ in fields))
        value = F.struct(*(got[name]["value"].alias(name) for name, _ in fields)).cast(struct_type(fields))
        return _result(F.when(error.isNull(), value), error)

    return _once(F.struct(*(_field(v, name, kind).alias(name) for name, kind in fields)), whole)


def strict_json(raw: Column, fields: tuple = EXTRACTION_FIELDS) -> Column:
    """struct(value, error) of an answer: exactly one of the two is null."""
    none = _none(struct_type(fields))

    def of_part(part: Column) -> Column:
        # Within a list of one, as text behind the object would be passed over else.
        parsed = F.when(~part.rlike(LONE), F.try_parse_json(F.concat(F.lit("["), part, F.lit("]"))))
        return F.when(part.isNull(), _result(none, F.lit("no JSON object in the answer"))).otherwise(_once(parsed, of_list))

    def of_list(every: Column) -> Column:
        broken = F.coalesce(F.try_variant_get(every, "$[1]", "variant").isNotNull() | every.isNull(), F.lit(True))
        return F.when(broken, _result(none, F.lit("json_invalid"))).otherwise(_once(F.try_variant_get(every, "$[0]", "variant"), lambda v: checked(v, fields)))

    return _once(json_slice(raw), of_part)
