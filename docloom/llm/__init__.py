"""Operators for text that feeds language models; nothing outside imports this."""
