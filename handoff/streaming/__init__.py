"""Structured Streaming: tail a run log, keep live run status, check and score arriving rows."""
