"""Readers: files, archives, JDBC, streams, logs and the fixed dimension tables."""
