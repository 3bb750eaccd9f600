"""Operators for preparing training text; nothing outside this subpackage imports it."""
