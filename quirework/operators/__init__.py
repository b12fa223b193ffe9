"""operators of the engine."""
