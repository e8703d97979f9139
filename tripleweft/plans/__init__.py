"""Plan builders: mapping compiler, fused text plans, join and indexing helpers."""
