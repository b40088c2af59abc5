"""Training-data operators. ``queries`` registers one driver query per operator."""
