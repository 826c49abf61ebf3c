"""Operators for preparing large training corpora; nothing outside uses them."""
