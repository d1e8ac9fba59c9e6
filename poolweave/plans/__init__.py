"""The four stages, composed of operators, sources and sinks."""
