"""DataFrame -> DataFrame operators of the retail pipeline."""
