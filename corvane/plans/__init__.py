"""Physical helpers shared by the operators: scratch tables, skew handling, ids, loops."""
