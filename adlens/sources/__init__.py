"""Readers (SRC1-SRC8) and the driver-table projections."""
