"""Incremental form of the typed bulk load (the reference has no stream operator)."""

from .ingest import load_history_stream

__all__ = ["load_history_stream"]
