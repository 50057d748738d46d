"""lanecast: daily lane price analytics on Spark DataFrames.

Layers: sources (scans, fixtures, layer tables) -> operators (staging,
mart, incremental upsert, coverage, quality) -> plans (pipeline runs,
saved reports, dashboard queries).  ``streaming`` re-aims the batch
ingestion at Structured Streaming.
"""

__version__ = "0.1.0"
