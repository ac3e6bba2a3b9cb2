"""Applying a fitted recipe and trained models to a streaming source."""

from tabsmith.streaming.apply import score_stream, transform_stream

__all__ = ["transform_stream", "score_stream"]
