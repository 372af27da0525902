"""Streams: sources, sinks and jobs."""
