"""Readers and writers of session stores."""
