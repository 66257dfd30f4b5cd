"""Readers, sinks, the feature store and the listing-shaped views."""
