"""Registered queries, each beside the SQL that computes the same from flat tables."""
