"""Compositions: bronze / silver / gold layers (layers.py), inputs derived from the supplied tables
(derived.py), the registered workloads (workloads.py) and their DuckDB oracles (oracle.py)."""
