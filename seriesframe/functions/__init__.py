"""Column expressions and the ordered-window helpers the operators share."""
