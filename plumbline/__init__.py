"""Data quality and portfolio analytics on Spark DataFrames."""

from plumbline.plans.export import export
from plumbline.plans.profile import Profile, profile
from plumbline.plans.quality import Results, run_quality
from plumbline.sources.catalog import load_tables, read_folder

__all__ = ["Profile", "Results", "export", "load_tables", "profile", "read_folder", "run_quality"]
