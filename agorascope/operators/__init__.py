"""Operators over posts and comments."""
