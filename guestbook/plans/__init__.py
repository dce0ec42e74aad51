"""Bindings of the operators to the driver's tables, with equivalent SQL."""
