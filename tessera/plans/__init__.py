"""Whole profiles out of channel tables, and the batch jobs around them."""
