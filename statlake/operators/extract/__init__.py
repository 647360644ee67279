"""Stat extraction from web pages and captured responses.

A page is one row and its stats stay in one array column of that row until they are exploded,
so that extracting, counting and choosing a source need no shuffle at all.
"""
