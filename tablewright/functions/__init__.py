"""Column expressions: numbers from text, and captures from log lines."""

from tablewright.functions.logs import log_fields, parse_log
from tablewright.functions.numbers import money_sum, parse_double, parse_long, strict_double, to_cents

__all__ = ["log_fields", "money_sum", "parse_double", "parse_log", "parse_long", "strict_double", "to_cents"]
