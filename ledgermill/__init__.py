"""Subscription-revenue reporting on Spark: messy extracts in, trusted metrics out."""
