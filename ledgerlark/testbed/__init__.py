"""Bridges the driver's test tables to the library: adapter, query catalogue and check SQL."""
