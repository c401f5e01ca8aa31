"""DataFrame -> DataFrame operators of the layers."""
