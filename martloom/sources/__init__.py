"""Readers and writers: staging tables, column profiles, marts."""
