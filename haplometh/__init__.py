"""Haplotype-phased DNA methylation analytics as Spark DataFrame operators."""

from haplometh.keys import SITE, with_by

__all__ = ["SITE", "with_by"]
