"""Test inputs derived from the given tables: readings payloads, replayed streams, a load profile."""
