"""Thresholds over label vectors.

The number of labels K is known when the plan is built (it is the size of the
label dictionary), so per-label work is written as K element accesses that
whole-stage codegen compiles (see ``sqltext.py``), instead of higher-order
lambdas or explodes.  A threshold is one scalar or one value per label.
"""

from __future__ import annotations


def per_label(t, k: int) -> list:
    """Expand a scalar threshold to K thresholds (a list passes through)."""
    if isinstance(t, (int, float)):
        return [float(t)] * k
    t = [float(x) for x in t]
    if len(t) != k:
        raise ValueError(f"expected {k} thresholds, got {len(t)}")
    return t
