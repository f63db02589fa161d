"""Registered queries over the shared test tables, with their SQL counterparts."""
