"""Connectors: file/table sources and sinks, JDBC and Kafka option builders."""
