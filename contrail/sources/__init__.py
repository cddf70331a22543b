"""Readers: files, the airport dimension, and HTTP feeds."""
