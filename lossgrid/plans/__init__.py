"""Whole jobs and the registered queries: operators applied to the loan book, with their SQL oracles."""
