"""Vessel-message stream: parse, zone filter, routing, counts."""
