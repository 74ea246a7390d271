"""End-to-end jobs. Each reads layers, composes operators, writes layers, returns figures."""
