"""Column functions: the tokenizer and the ranking formulas."""
