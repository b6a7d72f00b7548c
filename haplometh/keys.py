"""Key columns shared by every operator.

An interval is ``(chrom, start, end)``, 0-based and half-open; a CpG site is
the one-base interval of its ``C``. Operators take ``by``, extra equality
columns put in front of the key: ``by=("sample",)`` runs a whole cohort in one
job instead of one job per sample.
"""

from __future__ import annotations

from collections.abc import Sequence

SITE = ("chrom", "start", "end")


def with_by(by: Sequence[str], columns: Sequence[str] = SITE) -> list[str]:
    """The key ``columns`` with the cohort columns ``by`` in front."""
    return [*by, *columns]
