"""Topic, row and debug sinks."""
