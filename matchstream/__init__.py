"""matchstream: match-event analytics on Spark (batch and Structured Streaming).

Every metric is a plain ``DataFrame -> DataFrame`` function shared by batch
and streaming callers; sources and sinks live in their own packages.
"""

__version__ = "0.1.0"
