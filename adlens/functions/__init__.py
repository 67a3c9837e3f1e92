"""Column expressions used across the operators."""

from . import casts, dates, json_fields, ratios  # noqa: F401
