"""DataFrame operators the loads are made of."""
