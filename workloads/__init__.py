"""The driver's tables dressed as review tables, and the registered queries over them."""
