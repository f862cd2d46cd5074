"""Relational building blocks that hold when one key carries a large part of all rows."""
