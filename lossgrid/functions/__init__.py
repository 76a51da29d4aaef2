"""Column-level building blocks: normal distribution, keyed uniforms, bins, null-safe arithmetic."""
