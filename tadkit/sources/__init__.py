"""Sources and sinks: files, catalog tables, JDBC, persisted models."""
