"""Sinks: print, files, Kafka frames, keyed upserts, document frames,
JDBC staging, idempotent per-batch writes and state publishing."""
