"""Joins, candidate tiers, scoring, roll-ups and other table operators."""
