"""Readers and writers. Paths may be of any file system Spark knows."""
