"""hydrolake: Spark-native medallion transforms for reservoir, weather and hazard data.

Every public transform is a lazy ``DataFrame -> DataFrame`` function built from
built-in Spark SQL expressions.  Sub-packages:

* ``functions``  – Column builders (coercion, classification, keys, dates)
* ``operators``  – relational building blocks (dedup, joins, windows, aggregates, DQ)
* ``sources``    – scans, sinks and the adapters over the driver's tables
* ``plans``      – Silver / Gold / features / scoring / marts / exports pipelines
* ``streaming``  – Structured Streaming ingest and incremental state
"""

__version__ = "0.1.0"
