"""Streaming: intentionally empty.

The reference has no streaming sources, watermarks, stateful operators or
incremental materialisations -- every table is a full batch rebuild -- so
there is nothing to re-express with Structured Streaming here.
"""
