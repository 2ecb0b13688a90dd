"""Query plans over the driver tables (adapters + registered queries)."""
