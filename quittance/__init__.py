"""Document extraction on DataFrames: from model answers to typed invoice tables."""
