"""Readers, sinks, the inline city dimension and the derived test feeds."""

from .files import (
    read_raw_feed,
    read_availability_csv,
    read_ai_summaries,
    bronze_stamp,
)
from .sinks import write_table, write_partitioned, read_table
from .dimensions import city_dimension, STATE_CENTRES, COUNTRY_CENTRE

__all__ = [
    "read_raw_feed",
    "read_availability_csv",
    "read_ai_summaries",
    "bronze_stamp",
    "write_table",
    "write_partitioned",
    "read_table",
    "city_dimension",
    "STATE_CENTRES",
    "COUNTRY_CENTRE",
]
