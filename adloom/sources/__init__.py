"""Raw table registry, scans and sinks."""
