"""Relational operators of the loads: upsert, predicates, zone match, paging, commit log."""
