"""Readers and writers: loan CSV trees, delinquency CSV, the derived loan book, result tables."""
