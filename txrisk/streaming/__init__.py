"""Streaming sinks and the hops between tables."""
