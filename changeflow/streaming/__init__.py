"""Structured Streaming jobs: raw append and incrementally kept current state."""
