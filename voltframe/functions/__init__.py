"""Column expressions: typed access to dynamic JSON, and strict local time."""
from .json import Field, parse_strict
from .time import local_to_utc, parse_local, utc_text

__all__ = ["Field", "local_to_utc", "parse_local", "parse_strict", "utc_text"]
