"""Sinks: file exports, partitioned tables, staged publish, JDBC."""
