"""Column expressions: text, HTML, tokens, URLs and display values."""
