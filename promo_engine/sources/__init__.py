"""Readers and writers."""
from promo_engine.sources.tables import read_table  # noqa: F401
from promo_engine.sources.coupons import coupon_raw  # noqa: F401
