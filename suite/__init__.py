"""The registered queries: one or more per operator, each with its SQL counterpart."""

from suite import changes, decoding, notifications, progress, rendering, sources  # noqa: F401
from suite.base import ENTRIES

__all__ = ["ENTRIES"]
