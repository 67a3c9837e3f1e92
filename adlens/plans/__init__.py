"""Report builders composed from the operators (RB1-RB10)."""
