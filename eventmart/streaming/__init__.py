"""The load as a stream."""
