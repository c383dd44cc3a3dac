"""Readers: on-time CSV files, JSON events, streams, and a flights view over an event log."""
