"""Operators for preparing a text corpus for training."""
