"""Compositions: the declarations warehouse and the registered queries."""
