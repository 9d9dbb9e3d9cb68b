"""Record validation, profiling, linking and de-duplication on Spark DataFrames."""

from twinfold.schema import Field, MatchSchema, Tier, load_rules, preset

__all__ = ["Field", "MatchSchema", "Tier", "load_rules", "preset"]
