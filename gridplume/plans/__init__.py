"""Models, dashboard tiles and the two runs that tie the operators together."""
