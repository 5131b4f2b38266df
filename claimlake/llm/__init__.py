"""Operators that prepare text for language-model training; nothing outside this subpackage imports it."""
