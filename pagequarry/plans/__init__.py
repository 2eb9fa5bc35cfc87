"""Plan helpers shared by the operators: size-checked joins, distributed ordering, shared storage."""
