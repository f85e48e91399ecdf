"""Queries of the engine over the driver tables, with their SQL counterparts."""
