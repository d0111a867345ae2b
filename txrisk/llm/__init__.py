"""Operators for preparing large text corpora, each a job over whole tables."""
