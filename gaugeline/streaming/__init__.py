"""Streams: windowed aggregates, incremental upkeep of abnormal runs, pipelines."""
