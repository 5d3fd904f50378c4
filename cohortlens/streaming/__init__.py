"""Scoring on Structured Streaming (the fitted pipeline is a stateless map)."""

from cohortlens.streaming.scoring import score_stream, start_scoring

__all__ = ["score_stream", "start_scoring"]
