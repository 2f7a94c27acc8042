"""Jobs put together from the operators: maintenance, inventory, multi-table exports, whole programs."""
