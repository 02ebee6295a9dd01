"""Instants that tests build their rows from, in microseconds."""

SECOND, DAY = 1_000_000, 86_400_000_000
T0 = 1_704_067_200_000_000  # Monday, 2024-01-01 UTC
