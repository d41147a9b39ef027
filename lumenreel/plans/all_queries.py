"""Imports every module that registers queries."""

from . import gates, geometry, grouped, joined, levels, media, names, queues, reports, rules, texts, timeline, tracks  # noqa: F401
