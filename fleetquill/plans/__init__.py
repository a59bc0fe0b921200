"""Whole loads: they read, merge, write and leave a row in the load log."""
