"""evstar: retail event stream -> Parquet lake -> raw table -> star schema, on Spark.

Sub-packages:
  functions  Column-level helpers (keys, calendar, envelope parsing)
  operators  DataFrame-level operators (dedup, joins, data-quality checks, profiling)
  sources    Readers/writers for the lake, catalog snapshots and the topic
  streaming  Structured Streaming jobs (ingest, raw load, legacy per-type path)
  plans      Model definitions (staging, marts), the build gate and the pipeline
"""

__version__ = "0.1.0"
