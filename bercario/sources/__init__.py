"""Readers of the delimited inputs and the landing step before them."""
