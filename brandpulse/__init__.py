"""brandpulse — brand-sentiment analytics on Spark DataFrames and Structured Streaming.

Layers (all plain DataFrame -> DataFrame functions, no driver-side loops):

* ``sources``    readers, decoders, table writers (bronze/silver/gold, upsert, JDBC, Kafka options)
* ``functions``  column expressions (labels, bands, event-time parsing, display formats)
* ``operators``  serving queries, maintenance jobs, lexicon sentiment, topic tagging, data quality
* ``streaming``  the two-hop stream: source -> bronze -> silver fan-out, windowed counts
* ``plans``      adapters from the driver tables and the registered query catalogue
"""

from brandpulse.session import get_spark, work_dir  # noqa: F401

__all__ = ["get_spark", "work_dir"]
