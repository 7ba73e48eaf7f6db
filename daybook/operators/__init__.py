"""DataFrame steps and sinks."""
