"""The tables: clean transactions, summaries, and how they are kept up to date."""
