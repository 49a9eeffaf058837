"""Registered queries and, where SQL can say the same, their SQL."""

from airloom.queries import learning, profiling, series, shaping, streams

MODULES = (series, shaping, profiling, learning, streams)
