"""Operators of a training-data pipeline: scans, sharding, dedup, scoring, tokenizing, packing.

One module per operator; ``queries`` registers ``opN_<name>`` for each and
``sql`` holds the DuckDB oracles.  Nothing outside this subpackage imports it.
"""
