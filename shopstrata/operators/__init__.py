"""DataFrame to DataFrame operators of the four layers."""
