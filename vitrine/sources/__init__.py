"""Inputs and outputs: series lists, landed pages, page files, versioned tables."""
