"""Source definitions, readers and sinks."""
