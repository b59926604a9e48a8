"""Columns of a by-day table that change their type or name from one run to the next.

A table has a history of forms, the schemas that its runs wrote, in order. A later form may add
columns, widen types and rename columns; it may not narrow a type. Files stay as they were
written, and a read brings those of every form to the columns asked for.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Whole numbers, narrow to wide, with the digits that they need.
WHOLE = {T.ByteType: 3, T.ShortType: 5, T.IntegerType: 10, T.LongType: 19}


def widens(old: T.DataType, new: T.DataType) -> bool:
    """Whether every value of the old type is one of the new."""
    if old == new:
        return True
    kinds = type(old), type(new)
    if isinstance(new, T.DecimalType):
        if isinstance(old, T.DecimalType):
            return new.scale >= old.scale and new.precision - new.scale >= old.precision - old.scale
        return kinds[0] in WHOLE and new.precision - new.scale >= WHOLE[kinds[0]]
    if kinds[0] in WHOLE and kinds[1] in WHOLE:
        return WHOLE[kinds[0]] < WHOLE[kinds[1]]
    exact = {T.DoubleType: (T.FloatType, T.IntegerType, T.ShortType, T.ByteType)}
    return kinds[0] in exact.get(kinds[1], ()) or kinds == (T.DateType, T.TimestampNTZType)


def extended(history: dict | None, schema: T.StructType, renames: Mapping[str, str]) -> dict:
    """The history with a form of that schema as its last: ``forms`` and ``renames``, each with
    the number of forms that have the old name."""
    history = history or {"forms": [], "renames": []}
    forms = [T.StructType.fromJson(form) for form in history["forms"]]
    told = [[len(forms), old, new] for old, new in renames.items()]
    known = {"forms": history["forms"], "renames": [*history["renames"], *told]}
    for number, form in enumerate(forms):
        for field in form.fields:
            name = renamed(known, number, field.name)
            if name in schema.names:
                _checked(field, schema[name])
    if forms and not renames and _types(forms[-1]) == _types(schema):
        return known
    return {**known, "forms": [*known["forms"], schema.jsonValue()]}


def renamed(history: dict, number: int, name: str) -> str:
    """What the column of a form is called now."""
    for forms, old, new in history["renames"]:
        if number < forms and name == old:
            name = new
    return name


def columns(history: dict, number: int, schema: T.StructType) -> dict[str, Column] | None:
    """How the columns of ``schema`` are made of a form's; None if its files have them as they
    are, apart from those that they lack."""
    form = T.StructType.fromJson(history["forms"][number])
    held = {renamed(history, number, field.name): field for field in form.fields}
    found, plain = {}, True
    for field in schema.fields:
        if field.name not in held:
            found[field.name] = F.lit(None).cast(field.dataType)
            # A column of this name in the files is another one by now.
            plain &= field.name not in form.names
            continue
        source = held[field.name]
        _checked(source, field)
        plain &= source.name == field.name and source.dataType == field.dataType
        found[field.name] = F.col(source.name).cast(field.dataType)
    return None if plain else found


def _types(schema: T.StructType) -> list:
    return [(field.name, field.dataType) for field in schema.fields]


def _checked(old: T.StructField, new: T.StructField) -> None:
    if not widens(old.dataType, new.dataType):
        types = f"{old.dataType.simpleString()} to {new.dataType.simpleString()}"
        raise ValueError(f"column {new.name} would be narrowed from {types}")
