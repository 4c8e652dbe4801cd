"""Whole jobs: the two batch builds, the interactive questions, the stand-in tables."""
