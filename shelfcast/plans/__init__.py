"""Operators composed into whole runs."""
