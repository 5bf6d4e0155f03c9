"""Operators of a training-data pipeline at corpus scale, one module each.
Nothing else in the library imports them."""
