"""Operators of a training-data pipeline over ``documents`` tables. Nothing else in the library imports this folder."""
