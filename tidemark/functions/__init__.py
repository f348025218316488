"""Column expressions: text clean-up, parsing, classification and scoring."""
