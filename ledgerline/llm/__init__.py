"""Operators for preparing training data: counting, scoring, de-duplicating, mixing and writing text."""
