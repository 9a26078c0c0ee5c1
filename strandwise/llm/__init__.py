"""Training-data pipeline operators.

Self-contained: nothing else in the library imports this subpackage, and
removing it leaves the interval library whole.
"""
