"""The package for the Python workers of a session, for clusters where it is not installed."""

from __future__ import annotations

from tillroll.shipping import ship

__all__ = ["ship"]
