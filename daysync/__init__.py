"""Keep a day-partitioned target table in step with its source, as Spark jobs.

``sources``    day shards, their profiles, and tables on disk or in the catalog
``operators``  schema evolution, dedup, upsert, updates, append and joins
``plans``      what to do with each day, doing it, and reporting it
``sinks``      replacing, appending and exporting Parquet
``functions``  column expressions the rest is written with
"""
