"""Operators of a training-data pipeline over web-scale text (see the README of this folder).

Nothing else in the library imports this subpackage.
"""
