"""Queries over whole tables and their SQL counterparts."""
