"""Typed casts of nested values.

Casting an ``array<struct>`` to another ``array<struct>`` re-types *and*
renames the fields by position (names come from the target type).  The safe
form uses ``try_cast``: a value that does not fit (decimal overflow, bad text)
becomes null in that leaf only, and ``cast_lost`` tells whether that happened
so the row can be quarantined instead of silently losing data (quirk K18).
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orderloom.schemas import CHARGE_ARRAY, DESCRIPTION_ARRAY, PRICE_TYPE, TAX_ARRAY


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def typed(c, dtype: T.DataType, safe: bool = True) -> Column:
    """Positional re-type; ``try_cast`` when ``safe``."""
    c = _col(c)
    return c.try_cast(dtype) if safe else c.cast(dtype)


def charges(c, safe: bool = True) -> Column:
    return typed(c, CHARGE_ARRAY, safe)


def taxes(c, safe: bool = True) -> Column:
    return typed(c, TAX_ARRAY, safe)


def descriptions(c, safe: bool = True) -> Column:
    return typed(c, DESCRIPTION_ARRAY, safe)


def price(c, safe: bool = True) -> Column:
    return typed(c, PRICE_TYPE, safe)


def lost_elements(source, target, source_type: T.ArrayType, target_type: T.ArrayType) -> Column:
    """For each element of an array, whether its safe cast lost a leaf."""
    return F.zip_with(_col(source), _col(target),
                      lambda s, t: cast_lost(s, t, source_type.elementType, target_type.elementType))


def elements_lost(source, source_type: T.ArrayType, target_type: T.ArrayType) -> Column:
    """True when the safe cast of an array of structs nulls a leaf of it: as
    ``cast_lost`` of the array and its cast, with one pass over the source."""
    pairs = list(zip(source_type.elementType.fields, target_type.elementType.fields, strict=True))

    def lost(s):
        return reduce(lambda x, y: x | y, [cast_lost(s[a.name], typed(s[a.name], b.dataType), a.dataType, b.dataType)
                                           for a, b in pairs if a.dataType != b.dataType], F.lit(False))
    return F.coalesce(F.exists(_col(source), lost), F.lit(False))


def cast_lost(source, target, source_type: T.DataType, target_type: T.DataType) -> Column:
    """True when the safe cast nulled a leaf that was present in the source.

    Fields are matched by position; leaves whose type does not change are not
    looked at.
    """
    source, target = _col(source), _col(target)
    nulled = source.isNotNull() & target.isNull()
    if isinstance(target_type, T.StructType):
        pairs = zip(source_type.fields, target_type.fields, strict=True)
        inner = [cast_lost(source[a.name], target[b.name], a.dataType, b.dataType) for a, b in pairs
                 if a.dataType != b.dataType]
        return reduce(lambda x, y: x | y, inner, nulled)
    if isinstance(target_type, T.ArrayType):
        some = F.exists(lost_elements(source, target, source_type, target_type), lambda x: x)
        return nulled | F.coalesce(some, F.lit(False))
    return nulled
