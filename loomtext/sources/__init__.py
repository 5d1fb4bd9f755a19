"""Readers and writers. Each reader states what a missing file and a bad line are."""
