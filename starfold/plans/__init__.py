"""Composed plans: the batch pipeline and the driver-table star schema."""
