"""Column expressions: plain ``Column -> Column`` helpers, no Python UDFs."""
