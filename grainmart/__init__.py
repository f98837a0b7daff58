"""grainmart: roll history tables up to one trusted feature row per entity, on Spark."""

__version__ = "0.1.0"
