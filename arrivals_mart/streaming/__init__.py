"""Streaming entry points (see :mod:`arrivals_mart.streaming.incremental`)."""
