"""Composed plans: the registered queries, their SQL oracles, and the layered
staging -> intermediate -> marts build."""
