"""The load contract as file streams: what arrived is enriched once, counted by day, and archived."""
