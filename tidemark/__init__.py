"""Snapshot comparison on Spark DataFrames.

``tidemark`` compares two dated snapshots of an entity-metrics dataset. Every
public function takes DataFrames and returns DataFrames; the researcher schema
in ``tidemark.presets`` is one preset, nothing else depends on it.
"""

from tidemark.spec import CompareSpec, Metric, Rule

__all__ = ["CompareSpec", "Metric", "Rule"]
