"""Readers: delivered CSV, JSON baselines, stored tables, object listings, load log."""
