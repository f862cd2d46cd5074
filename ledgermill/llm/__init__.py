"""Operators for preparing training data: one module for each, beside shared helpers."""
