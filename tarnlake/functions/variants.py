"""Values of variants as columns of a type, and whether they fit it whole."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, IntegralType, StructType


def _place(name: str) -> str:
    """The path of a member of an object."""
    quote = '"' if "'" in name else "'"
    return f"$[{quote}{name}{quote}]"


def member(record: Column, name: str) -> Column:
    """A member of a variant object, as a variant."""
    return F.try_variant_get(record, _place(name), "variant")


def variant_as(value: Column, kind: DataType) -> tuple[Column, Column]:
    """A variant as ``kind``, and whether that holds all of it.

    Text holds anything. A fraction does not fit a whole number, an object with a member that
    the record does not have does not fit the record, and a list or record fits if its parts do.
    """
    if isinstance(kind, StructType):
        members = F.try_variant_get(value, "$", "map<string,variant>")
        parts = {field.name: variant_as(member(value, field.name), field.dataType) for field in kind}
        known = F.array(*[F.lit(name) for name in parts])
        fits = members.isNotNull() & (F.size(F.array_except(F.map_keys(members), known)) == 0)
        for _, fit in parts.values():
            fits = fits & fit
        record = F.struct(*[part.alias(name) for name, (part, _) in parts.items()])
        return F.when(members.isNotNull(), record), F.coalesce(fits, F.lit(False)) | _nothing(value)
    if isinstance(kind, ArrayType):
        items = F.try_variant_get(value, "$", "array<variant>")
        fits = F.forall(items, lambda item: variant_as(item, kind.elementType)[1])
        found = F.transform(items, lambda item: variant_as(item, kind.elementType)[0])
        return found, F.coalesce(fits, F.lit(False)) | _nothing(value)
    found = F.try_variant_get(value, "$", kind.simpleString())
    fits = found.isNotNull()
    if isinstance(kind, IntegralType):
        fraction = F.try_variant_get(value, "$", "double")
        fits = fits & (fraction.isNull() | (fraction == found.cast("double")))
    return found, F.coalesce(fits, F.lit(False)) | _nothing(value)


def _nothing(value: Column) -> Column:
    return F.coalesce(value.isNull() | F.is_variant_null(value), F.lit(True))


def fitting(record: Column, name: str, kind: DataType) -> Column:
    """The member ``name`` of a variant object as ``kind``; null where it is not there or does not fit whole."""
    if not isinstance(kind, (StructType, ArrayType)):
        # As ``variant_as``, without a variant made of each member first: null is null either way.
        found = F.try_variant_get(record, _place(name), kind.simpleString())
        if not isinstance(kind, IntegralType):
            return found
        fraction = F.try_variant_get(record, _place(name), "double")
        return F.when(F.coalesce(fraction == found.cast("double"), F.lit(True)), found)
    found, fits = variant_as(member(record, name), kind)
    return F.when(fits, found)
