"""Whole jobs: extract to forecast table, training, monitoring."""
