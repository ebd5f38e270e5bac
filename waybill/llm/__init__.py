"""Operators for preparing text that language models are trained on."""
