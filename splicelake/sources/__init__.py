"""Sources of the annotation engine."""
