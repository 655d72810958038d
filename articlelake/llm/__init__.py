"""Operators for preparing large text corpora, their queries and their SQL."""
