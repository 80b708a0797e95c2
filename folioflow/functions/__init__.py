"""Column expressions: URLs, text normalisation, JSON-LD and DOM access."""
