"""Tests: hand-built fixtures, cross-checks, invariants, oracle parity, scale properties."""
