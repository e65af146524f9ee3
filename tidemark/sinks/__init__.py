"""Writers of the lake tiers and their upkeep."""
