"""Structured Streaming jobs: topic -> lake (ingest), lake -> raw table (load)."""

from .ingest import ingest, write_micro_batch
from .load import load_projection, load_raw
from .stage import read_staged_orders, stage_orders

__all__ = ["ingest", "load_projection", "load_raw", "read_staged_orders", "stage_orders", "write_micro_batch"]
