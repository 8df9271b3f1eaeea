"""Operators: DataFrame -> DataFrame functions for batch and streaming frames."""
