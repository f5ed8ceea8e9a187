"""Streaming.

The analysed project reads only bounded inputs, so its batch operators live
in ``operators``.  The one rule it proposes for real-time use — the
early-warning threshold alert — also runs here as a Structured Streaming
job (``alerts``): stateless breach filter, stream-static window join to the
stay anchors, idempotent foreachBatch sink.
"""
