"""Operators for preparing training text: quality, near copies, privacy, mixing, packing and more."""
