"""Writers and catalog tables (SNK1-SNK6)."""
