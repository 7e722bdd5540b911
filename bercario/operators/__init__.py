"""Dataframe operators: cleaning, sampling, label lookups, key checks and table writes."""
