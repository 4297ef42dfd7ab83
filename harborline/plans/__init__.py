"""Compositions: registered queries, their oracles, fixtures and load jobs."""
