"""Typed errors raised by the library."""

from __future__ import annotations


class MissingInputError(FileNotFoundError):
    """A declared input path holds no data; the message names the path."""


class SchemaConflictError(ValueError):
    """Two columns would end up with the same name."""
