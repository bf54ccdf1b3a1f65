"""Column expressions: cleaning, local time, ratios and labels."""
