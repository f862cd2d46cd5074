"""Batch jobs. Each takes its folders explicitly, so they can be on any shared file system."""
