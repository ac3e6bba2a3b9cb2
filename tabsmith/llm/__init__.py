"""Training-data operators: dedup, decontamination, scoring, formatting, token output."""
