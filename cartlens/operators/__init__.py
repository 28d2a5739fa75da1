"""DataFrame -> DataFrame operators of the basket analysis."""
