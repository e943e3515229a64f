"""Micro-batch use of the batch operators."""
