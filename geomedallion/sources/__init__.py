"""Readers: landed payloads (S1-S4, landed.py) and header CSV bound by name (S5/S8, csv.py)."""
