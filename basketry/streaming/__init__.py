"""Streaming.

The reference has no streams, watermarks, time windows or state: all of its
jobs are batch, and nothing is added here. The counting operators are plain
DataFrame transforms, so ``word_count`` and ``degree_count`` also apply
unchanged to a streaming DataFrame (``spark.readStream.text(...)``) with any
sink that Spark offers for complete or update mode.
"""
