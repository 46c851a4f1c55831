"""Readers and writers: relational extracts, landed column files, delimited text, snapshots."""
