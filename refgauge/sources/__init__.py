"""Reading and writing page, score and feature tables."""
