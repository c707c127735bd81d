"""Declared specs: registers, contracts, extraction, vocabularies, the schema catalogue, dispatch."""
