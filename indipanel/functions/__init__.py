"""Column expressions; all of them stay inside generated JVM code."""

from .expressions import (  # noqa: F401
    blank_to_null,
    classify,
    content_hash,
    dictionary,
    entity_type,
    outcome,
    safe_divide,
    safe_float,
    safe_int,
)
