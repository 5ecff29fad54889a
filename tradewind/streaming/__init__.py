"""The session rollup on a stream of events."""
