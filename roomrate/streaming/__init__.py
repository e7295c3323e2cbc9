"""Structured Streaming form of the scoring step.

The reference has no stream: every input is one static file. The only
streaming piece here is M5 (``predict``) run over a file stream of new
listings, so a fitted price model can score listings as they land.
"""

from roomrate.streaming.score import score_stream

__all__ = ["score_stream"]
