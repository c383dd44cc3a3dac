"""Event-time analytics for flight operations data, written as Spark DataFrame jobs."""

from skyledger.params import JobParams
from skyledger.session import build_session, scratch_dir

__all__ = ["JobParams", "build_session", "scratch_dir"]
