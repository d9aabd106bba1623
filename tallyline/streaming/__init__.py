"""The same job as a stream."""
