"""Column -> Column scalar functions."""

from . import levels, names, numeric, text, time, types  # noqa: F401
