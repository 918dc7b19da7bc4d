"""Volume sources, sinks and metadata."""
