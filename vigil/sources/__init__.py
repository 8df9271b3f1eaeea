"""Sources and sinks: Kafka, files, JDBC, CSV, tables; and the test-table adapter."""
