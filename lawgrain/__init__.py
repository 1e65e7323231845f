"""Spark-native ingestion and cataloguing of large Akoma Ntoso document corpora.

Every operator is a function from DataFrame (or Column) to DataFrame (or
Column) with its parameters explicit; nothing here talks to the network.
"""

from lawgrain.params import CrawlParams
from lawgrain.session import build_session, scratch_dir

__all__ = ["CrawlParams", "build_session", "scratch_dir"]
