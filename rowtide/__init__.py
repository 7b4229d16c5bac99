"""Change-data decoding, message routing and result rendering on Spark.

Every operator is a function over ``DataFrame`` or ``Column``; the same code
serves batch tables and Structured Streaming micro-batches.
"""

from rowtide.session import configure

__all__ = ["configure"]
