"""Readers and writers: feed registry, feed documents, topics, tables."""
