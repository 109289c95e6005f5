"""Training-data operators: scoring, filtering, de-duplication, decontamination, packing."""
