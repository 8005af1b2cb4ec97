"""Terravane: map-feature processing as lazy Spark DataFrame operators."""
