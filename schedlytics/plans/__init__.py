"""Business jobs composed from the operators."""
