"""Operators of a training-data pipeline; each module builds one of them."""
