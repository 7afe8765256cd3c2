"""DataFrame to DataFrame operators of the annotation engine."""
