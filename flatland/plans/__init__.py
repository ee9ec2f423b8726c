"""Feed configuration, mapping specs and the plans built from them."""
