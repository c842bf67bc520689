"""Registered queries, the log views they read, and their independent oracles."""
