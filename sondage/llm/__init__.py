"""Operators for preparing training data: cleaning, filtering, matching and packing texts."""
