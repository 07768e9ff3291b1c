"""Column functions: text, anchors, geometry and unit predicates."""
