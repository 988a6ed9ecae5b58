"""Readers and writers for landed feeds, API pages and snapshot logs."""
