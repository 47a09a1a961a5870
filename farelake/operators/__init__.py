"""DataFrame -> DataFrame operators of each layer."""
