"""Readers of landed data. Network access is left to whatever lands the files."""
