"""Soil-survey, laboratory and station analytics as DataFrame operators."""

from loamframe.session import checkpoint_root, configure

__all__ = ["checkpoint_root", "configure"]
