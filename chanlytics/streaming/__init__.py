"""Structured Streaming entry points for incremental ingest."""

from chanlytics.streaming.incremental import (
    start_export_ingest, start_image_scoring, start_landing_ingest,
)

__all__ = ["start_export_ingest", "start_landing_ingest", "start_image_scoring"]
