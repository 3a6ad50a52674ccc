"""The same plans over pages that keep arriving."""
