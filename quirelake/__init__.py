"""Catalogue analytics on Spark: Bronze -> Silver -> Gold -> warehouse."""
