"""Registered queries, each next to the SQL that checks it."""

from __future__ import annotations

from entitylake.plans.catalog import bodies, payloads, search, shaping, stored, text, workflows
from entitylake.plans.catalog.registry import CHECKS, QUERIES

__all__ = ["CHECKS", "QUERIES", "bodies", "payloads", "search", "shaping", "stored", "text", "workflows"]
