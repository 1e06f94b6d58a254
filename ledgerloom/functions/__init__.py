"""Column functions: masks, safe casts, rounding and text helpers."""
