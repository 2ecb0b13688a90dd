"""Readers: Kafka (or Kafka-shaped files), event files, JDBC, reference files."""
