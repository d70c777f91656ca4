"""Operators for building language-model training data from documents and web pages."""
