"""Operators of a training-data pipeline.

Nothing outside this package imports it; ``lamina.llm.registry`` lists its
queries for the driver contract.
"""
