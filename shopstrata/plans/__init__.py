"""Layer jobs composed from the operators."""
