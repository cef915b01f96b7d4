"""Streaming: intentionally empty.

The reference has no stream source, watermark, window over event time or
stateful operator (SURVEY 2.13), so nothing is built here.  The row-wise
operators in ``quarry.functions`` and ``quarry.operators.project`` are plain
column expressions and apply unchanged to a streaming DataFrame.
"""
