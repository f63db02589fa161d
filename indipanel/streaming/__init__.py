"""Landing folder as a stream."""

from .ingest_stream import ingest_stream  # noqa: F401
