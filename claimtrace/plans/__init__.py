"""Report queries built from the operators."""
