"""Operators that are more than one built-in expression."""
