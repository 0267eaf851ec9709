"""Readers: monthly feed files, repacked feeds, zones, CSV, Kafka."""
