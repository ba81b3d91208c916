"""MLlib models on top of the operators."""
