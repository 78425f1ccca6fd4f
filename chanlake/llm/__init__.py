"""Training-data operators: ten dealt operators, their queries and SQL."""
