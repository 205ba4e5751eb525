"""haze: air-quality and weather analytics as PySpark DataFrame jobs.

Subpackages: ``sources`` (landed payloads, seeds, driver-table fixtures),
``functions`` (Column helpers, joins), ``operators`` (validation, staging,
enrichment, marts, windows, quality, backfill), ``streaming`` (incremental
ingest, watermarked pivot), ``plans`` (pipeline run, registered queries,
oracle SQL); ``sinks`` writes tables, ``cli`` is the command line.
"""

__version__ = "0.1.0"
