"""starloom: star-schema building blocks on Spark DataFrames.

Every public operator takes and returns ``pyspark.sql.DataFrame`` (or
``Column``) objects and leaves physical planning to Catalyst/AQE.

Layout:
  functions/  column expressions (date parsing, lap times, safe casts, names)
  operators/  relational operators (SCD1 merge, surrogate keys, lookups,
              calendar dimension, roll-ups, fact assembly, analyses)
  sources/    landing-folder listing, config-driven ingestion, table readers
  sinks/      table writes, versioned replace, export
  streaming/  incremental landing-folder ingestion with Structured Streaming
  plans/      jobs composed from the above (retail bindings, racing loads)
"""

__version__ = "0.1.0"
