"""Reading raw files, landing Bronze batches, seeds and generated relations; writing tables."""
