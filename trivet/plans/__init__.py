"""Relations, compositions and registered queries."""
