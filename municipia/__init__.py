"""Yearly regional statistics on Spark: clean, classify, roll up, densify, rank, export."""

from municipia.params import Selection
from municipia.session import build_session, ensure_checkpoint_dir, tune

__all__ = ["Selection", "build_session", "ensure_checkpoint_dir", "tune"]
