"""Incremental (streaming) validation: additive checks per micro-batch, and keyed state for the others."""

from .incremental import (
    foreign_key_check,
    null_count_check,
    row_rule_check,
    stream_totals,
    validate_stream,
)
from .keyed_state import KeyedState

__all__ = ["KeyedState", "foreign_key_check", "null_count_check", "row_rule_check", "stream_totals", "validate_stream"]
