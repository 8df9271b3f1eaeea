"""vigil: card-transaction alerting on Spark.

Operators are plain functions DataFrame -> DataFrame. The same ingest, cleaning,
alert and window functions serve batch tables and Structured Streaming frames.

Layout
  api            one import point for the pipeline functions
  session        SparkSession builder, shared-folder helpers, package shipping
  schemas        StructTypes and column lists of the bronze/silver/gold tables
  constants      fixed values (rule weights, window sizes, names)
  functions/     column expressions (ids, masks, formatting, time buckets)
  sources/       Kafka, file, JDBC and CSV sources; table sinks; test-table adapter
  operators/     silver cleaning, expectations, alerts, windows, rules, notifications
  plans/         monitoring reports and the query registry
  streaming/     streaming flows, stateful scoring, outbox sink
"""

__version__ = "0.1.0"
