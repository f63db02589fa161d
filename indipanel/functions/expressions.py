from __future__ import annotations

from itertools import chain

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import rules

# Unicode white space
_WHITE_SPACE = "".join(map(chr, [
    *range(0x09, 0x0E), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]))


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def blank_to_null(c: Column | str) -> Column:
    """Text without surrounding white space (tabs too); empty becomes NULL."""
    return F.nullif(F.trim(_col(c), F.lit(_WHITE_SPACE)), F.lit(""))


def safe_int(c: Column | str) -> Column:
    return _col(c).try_cast("bigint")


def safe_float(c: Column | str) -> Column:
    return _col(c).try_cast("double")


def safe_divide(a: Column | str, b: Column | str) -> Column:
    """Division as double; NULL where the divisor is zero."""
    return F.try_divide(_col(a).cast("double"), _col(b).cast("double"))


def entity_type(known_type: Column | str, code: Column | str) -> Column:
    """Type from the metadata; without it, a missing code means an aggregate."""
    return (
        F.when(_col(known_type).isNotNull(), _col(known_type))
        .when(_col(code).isNull(), rules.ENTITY_AGGREGATE)
        .otherwise(rules.ENTITY_UNKNOWN)
    )


def dictionary(c: Column | str, entries: dict[str, str]) -> Column:
    """Look a code up in a fixed dictionary; NULL when it is not there.

    A literal map is a projection: no join, no exchange, however large the input.
    """
    pairs = chain.from_iterable((F.lit(k), F.lit(v)) for k, v in entries.items())
    return F.try_element_at(F.create_map(*pairs), _col(c))


def classify(value: Column | str, bounds: list[Column], names) -> Column:
    """First class whose inclusive upper bound holds the value, else the last.

    NULL when the value or the bounds are missing.
    """
    v = _col(value)
    ladder = F.when(v.isNull() | bounds[0].isNull(), F.lit(None).cast("string"))
    for bound, name in zip(bounds, names):
        ladder = ladder.when(v <= bound, name)
    return ladder.otherwise(names[len(bounds)])


def outcome(actual: Column | str, predicted: Column | str) -> Column:
    """Pending without an actual class, otherwise right or wrong."""
    return (
        F.when(_col(actual).isNull(), rules.OUTCOME_PENDING)
        .when(_col(actual) == _col(predicted), rules.OUTCOME_RIGHT)
        .otherwise(rules.OUTCOME_WRONG)
    )


def _sorted_struct(c: Column, dtype: T.StructType) -> Column:
    fields = sorted(dtype.fields, key=lambda f: f.name)
    parts = []
    for f in fields:
        child = c.getField(f.name)
        if isinstance(f.dataType, T.StructType):
            child = F.when(child.isNotNull(), _sorted_struct(child, f.dataType))
        parts.append(child.alias(f.name))
    return F.struct(*parts)


def content_hash(schema: T.StructType, columns=None) -> Column:
    """SHA-256 over the row as JSON with sorted keys and explicit nulls.

    Only the named columns count, so load-time columns never change the hash.
    """
    wanted = set(columns if columns is not None else schema.fieldNames())
    parts = []
    for f in sorted((f for f in schema.fields if f.name in wanted), key=lambda f: f.name):
        c = F.col(f.name)
        if isinstance(f.dataType, T.StructType):
            c = F.when(c.isNotNull(), _sorted_struct(c, f.dataType))
        parts.append(c.alias(f.name))
    return F.sha2(F.to_json(F.struct(*parts), {"ignoreNullFields": "false"}), 256)
