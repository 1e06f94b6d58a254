"""Business plans: each stage maps DataFrames and settings to DataFrames and stays lazy."""
