"""Structured Streaming jobs for the late-arriving feeds (ST1-ST4)."""
