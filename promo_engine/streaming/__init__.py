"""Structured Streaming form of the cleaning/label stage and the daily
receipt report, for coupon logs that arrive as files."""
