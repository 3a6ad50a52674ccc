"""End-to-end plans: landed pages to keyed tables."""
