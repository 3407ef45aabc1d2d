"""Reading streams, in batch and continuously."""
