"""Part of sievework."""
