"""Baseball-named compositions of the generic operators."""
