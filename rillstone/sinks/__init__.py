"""Writers for batch and streaming results."""
