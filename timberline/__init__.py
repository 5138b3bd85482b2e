"""Batch analytics over container logs and trip records, written as Spark DataFrame jobs."""

from timberline.session import clean_scratch, materialize, scratch_path, session

__all__ = ["clean_scratch", "materialize", "scratch_path", "session"]
