"""Composed jobs: the retail feature chain, training, scoring, drift monitoring, and the query catalog."""
