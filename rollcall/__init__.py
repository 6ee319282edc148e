"""Observation reconciliation on Spark: noisy tool observations in, auditable entity tables out."""
