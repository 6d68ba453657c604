"""Models fitted from distributed sufficient statistics, boosted trees, stacking."""
