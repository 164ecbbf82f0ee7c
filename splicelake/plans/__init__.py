"""Plans of the annotation engine."""
