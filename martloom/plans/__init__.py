"""Complete load jobs composed from the operators."""
