"""Readers (S1-S4, S6), writers (K1, K2) and bindings of the driver tables."""

from starmart.sources.readers import (PipelineConfig, read_csv_table, read_events,
                                      read_table)
from starmart.sources.writers import stage_table, write_table

__all__ = ["PipelineConfig", "read_csv_table", "read_events", "read_table", "stage_table",
           "write_table"]
