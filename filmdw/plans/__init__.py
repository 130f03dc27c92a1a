"""Stage order of the warehouse load, and the registered queries."""
