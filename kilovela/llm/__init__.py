"""Operators for training-text data; nothing outside this subpackage imports it."""
