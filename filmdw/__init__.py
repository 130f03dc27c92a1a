"""Star-schema analytics for catalogues of items, written for Spark."""

from filmdw.session import build_session

__all__ = ["build_session"]
