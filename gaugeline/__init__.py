"""Cleaning and judging of industrial sensor readings as Spark jobs."""

from gaugeline.session import build_session, shared_folder

__all__ = ["build_session", "shared_folder"]
