"""Genomic views over ``lineitem``, ``orders``, ``customer`` and ``documents``.

Each view is one SELECT that Spark SQL and DuckDB read alike. ``start_`` and
``end_`` stand for the reserved words; :func:`spark_view` renames them.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

TABLES = ("lineitem", "orders", "customer", "supplier", "nation", "documents")

_CPG_SITE = """'chr' || CAST(1 + l_orderkey % 22 AS STRING) AS chrom,
       l_orderkey*50 + l_linenumber*7 AS start_, l_orderkey*50 + l_linenumber*7 + 1 AS end_"""

VIEWS: dict[str, str] = {}

VIEWS["fx_cpg"] = f"""
SELECT {_CPG_SITE},
       max(CASE WHEN l_returnflag <> 'R' THEN l_discount*10 END) AS methylation_level_hap1,
       max(CASE WHEN l_linestatus = 'F' THEN l_tax*10 END) AS methylation_level_hap2,
       max(CASE WHEN l_returnflag <> 'R' THEN CAST(l_quantity AS BIGINT) END) AS total_read_count_hap1,
       max(CASE WHEN l_linestatus = 'F' THEN CAST(l_quantity AS BIGINT) END) AS total_read_count_hap2
FROM lineitem GROUP BY 1, 2, 3"""

VIEWS["fx_snv"] = """
SELECT 'chr' || CAST(1 + o_orderkey % 22 AS STRING) AS chrom,
       o_orderkey*50 + 7*(1 + o_custkey % 7) + o_custkey % 2 AS start_,
       o_orderkey*50 + 7*(1 + o_custkey % 7) + o_custkey % 2 + 1 AS end_,
       CASE WHEN o_orderkey % 17 = 0 THEN 'AC' ELSE substr('ACGT', CAST(1 + o_custkey % 4 AS INT), 1) END AS ref,
       CASE WHEN o_orderkey % 10 = 3 THEN 'C,G' ELSE substr('CGTA', CAST(1 + o_custkey % 4 AS INT), 1) END AS alt,
       CASE WHEN o_orderkey % 10 = 0 THEN './.' WHEN o_orderkey % 10 IN (1, 2) THEN '1/1'
            WHEN o_orderkey % 10 = 3 THEN '0/2' WHEN o_orderkey % 10 = 4 THEN '0/0' ELSE '0|1' END || ':12:34' AS gt_raw,
       CAST(floor(o_totalprice) AS BIGINT) % 2 AS allele_hap1,
       (CAST(floor(o_totalprice) AS BIGINT) + CAST(floor(o_orderkey*50/20000.0) AS BIGINT)
         + CASE WHEN o_orderpriority = '1-URGENT' AND o_custkey % 3 = 0 THEN 1 ELSE 0 END) % 2 AS allele_pat,
       CAST(floor(o_orderkey*50/20000.0) AS BIGINT) AS phase_block_id
FROM orders"""

VIEWS["fx_phase_block"] = """
SELECT chrom, phase_block_id, min(start_) AS start_, max(end_) + 20 AS end_, count(*) AS num_variants
FROM fx_snv GROUP BY chrom, phase_block_id"""

VIEWS["fx_iht_block"] = """
SELECT chrom, min(start_) - 5 AS start_, max(end_) + 5 AS end_,
       max(substr('ABCD', CAST(1 + phase_block_id % 4 AS INT), 1)) AS founder_label_pat,
       max(substr('EFGH', CAST(1 + phase_block_id % 4 AS INT), 1)) AS founder_label_mat
FROM fx_snv GROUP BY chrom, CAST(floor((start_ + 10000)/30000.0) AS BIGINT)"""

VIEWS["fx_variant"] = """
SELECT chrom, start_, end_, ref, alt, gt_raw FROM fx_snv
UNION ALL
SELECT chrom, CASE WHEN (start_ % 50) % 7 = 0 THEN start_ + 1 ELSE start_ - 1 END AS start_,
       CASE WHEN (start_ % 50) % 7 = 0 THEN end_ + 1 ELSE end_ - 1 END AS end_, ref, alt, '1|1:9:9' AS gt_raw
FROM fx_snv WHERE start_ % 3 = 0"""

VIEWS["fx_mismatch"] = """
SELECT chrom, start_, end_ FROM fx_snv
WHERE chrom <> 'chr22' AND allele_hap1 <> allele_pat AND phase_block_id % 2 = 0"""

# The two callers' SNVs: alternative alleles differ where the genotype is unknown.
VIEWS["fx_read"] = """
SELECT chrom, start_, end_, ref, alt, CAST(phase_block_id AS STRING) AS phase_block_id,
       CAST(allele_hap1 AS STRING) AS allele_hap1, CAST(1 - allele_hap1 AS STRING) AS allele_hap2
FROM fx_snv"""

VIEWS["fx_iht"] = """
SELECT chrom, start_, end_, ref, CASE WHEN gt_raw LIKE './.%' AND allele_pat = 1 THEN 'N' ELSE alt END AS alt,
       CAST(allele_pat AS STRING) AS allele_pat, CAST(1 - allele_pat AS STRING) AS allele_mat
FROM fx_snv"""


def _pileup(where: str, when: str, level: str, reads: str = "CAST(l_quantity AS BIGINT)") -> str:
    """A pileup file: sites that pass ``where`` and whose level is known under ``when``."""
    return f"""
SELECT {_CPG_SITE}, max({reads}) AS total_read_count, max({level}) AS methylation_level
FROM lineitem WHERE {where} AND {when} GROUP BY 1, 2, 3"""


# Pileup files of a trio: a member's sites, then level and presence per mode and haplotype.
# The kid's model-mode counts differ from the count-mode ones at some sites.
_KID_MODEL_READS = "CAST(l_quantity AS BIGINT) + CASE WHEN l_discount = 0.05 THEN 1 ELSE 0 END"
_MEMBERS = {
    "kid": ("l_quantity >= 1", ("l_returnflag <> 'R'", "l_linestatus = 'F'"), ("l_discount*10", "l_tax*10")),
    "dad": ("l_discount >= 0.02", ("l_returnflag <> 'A'", "l_linestatus = 'O'"), ("l_tax*10", "l_discount*10")),
    "mom": ("l_tax <= 0.06", ("l_returnflag <> 'N'", "l_linestatus = 'F'"), ("l_discount*5", "l_tax*5")),
}
#: A pileup file's condition on rows, condition on a known level, level and reads, by member, mode and haplotype.
PILEUPS: dict[tuple[str, str, str], tuple[str, str, str, str]] = {}
for _member, (_where, _whens, _levels) in _MEMBERS.items():
    for _i, _hap in enumerate(("hap1", "hap2")):
        PILEUPS[_member, "count", _hap] = (_where, _whens[_i], _levels[_i], "CAST(l_quantity AS BIGINT)")
        PILEUPS[_member, "model", _hap] = (
            f"{_where} AND l_quantity >= 4",
            _whens[_i],
            _levels[1 - _i],
            _KID_MODEL_READS if (_member, _hap) == ("kid", "hap1") else "CAST(l_quantity AS BIGINT)",
        )
    for _mode, _level in zip(("count", "model"), _levels):
        PILEUPS[_member, _mode, "combined"] = (_where, "l_extendedprice > 0", _level, "CAST(l_quantity AS BIGINT)")
for (_member, _mode, _hap), _file in PILEUPS.items():
    VIEWS[f"fx_{_member}_{_mode}_{_hap}"] = _pileup(*_file)

# Reference CpGs: sites the sample shares, and sites near orders that it lost.
VIEWS["fx_reference"] = f"""
SELECT {_CPG_SITE} FROM lineitem WHERE l_discount > 0.0
UNION
SELECT 'chr' || CAST(1 + o_orderkey % 22 AS STRING) AS chrom, o_orderkey*50 + 3 AS start_, o_orderkey*50 + 4 AS end_
FROM orders"""

VIEWS["fx_trio_snv"] = """
SELECT chrom, start_, end_, ref, alt,
       CASE WHEN o_custkey % 5 = 0 THEN '1/1' WHEN o_custkey % 11 = 0 THEN '0/1' WHEN o_custkey % 13 = 0 THEN './.'
            WHEN allele_hap1 = 1 THEN '1|0' ELSE '0|1' END AS gt_kid,
       CASE WHEN o_orderstatus = 'P' THEN '0/1' WHEN allele_pat = 1 THEN '1|0' ELSE '0|1' END AS gt_dad,
       CASE WHEN o_orderpriority = '5-LOW' THEN './.' WHEN o_orderpriority = '3-MEDIUM' THEN '1|1'
            WHEN allele_pat = allele_hap1 THEN '1|0' ELSE '0|1' END AS gt_mom
FROM (SELECT s.*, o_custkey, o_orderstatus, o_orderpriority FROM fx_snv s JOIN orders o
      ON s.start_ = o_orderkey*50 + 7*(1 + o_custkey % 7) + o_custkey % 2) AS joined"""

for _member, _shift, _width in (("kid", 0, 20000), ("dad", 5000, 25000), ("mom", 12000, 35000)):
    VIEWS[f"fx_{_member}_block"] = f"""
SELECT chrom, CAST(floor((start_ + {_shift})/{_width}.0) AS BIGINT) AS phase_set, min(start_) - 3 AS start_,
       max(end_) + 3 AS end_, count(*) AS num_variants
FROM fx_trio_snv GROUP BY chrom, CAST(floor((start_ + {_shift})/{_width}.0) AS BIGINT)"""

# Document text spelled in bases; other characters stay and never form a CG.
VIEWS["fx_sequence"] = """
SELECT 'chr' || CAST(doc_id AS STRING) AS chrom, doc_id * 100 AS offset_,
       translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz',
                 'ACGTACGTACGTACGTACGTACGTACacgtacgtacgtacgtacgtacgtac') AS seq
FROM documents"""


def with_views(select: str, extra: dict[str, str] | None = None) -> str:
    """``select`` preceded by the CTEs of every view it needs, in dependency order."""
    known = {**VIEWS, **(extra or {})}
    needed: list[str] = []

    def visit(text: str) -> None:
        for name in re.findall(r"\b[a-z]+_\w+\b", text):
            if name in known and name not in needed:
                visit(known[name])
                if name not in needed:
                    needed.append(name)

    visit(select)
    if not needed:
        return select
    return "WITH " + ",\n".join(f"{n} AS ({known[n]})" for n in needed) + "\n" + select


_tables: dict[tuple[str, str, str], DataFrame] = {}


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """A driver table; its file footer is read once per session."""
    key = (spark.sparkContext.applicationId, folder, name)
    if key not in _tables:
        _tables[key] = spark.read.parquet(f"{folder}/{name}.parquet")
    return _tables[key]


def spark_view(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """A view as a DataFrame with the library's column names."""
    text = with_views(f"SELECT * FROM {name}")
    used = [t for t in TABLES if re.search(rf"\b{t}\b", text)]
    for t in used:
        text = re.sub(rf"\b{t}\b", "{" + t + "}", text)
    df = spark.sql(text, **{t: table(spark, folder, t) for t in used})
    return df.withColumnsRenamed({"start_": "start", "end_": "end", "ref": "REF", "alt": "ALT", "offset_": "offset"})


def pileup_names(members: tuple[str, ...], haplotypes: tuple[str, ...]) -> list[tuple[str, str, str]]:
    """The files that ``spark_pileups`` builds, in the order of their bits."""
    return [name for name in PILEUPS if name[0] in members and name[2] in haplotypes]


def spark_pileups(spark: SparkSession, folder: str, members: tuple[str, ...], haplotypes: tuple[str, ...]) -> DataFrame:
    """Members' pileup views side by side from one scan and one exchange.

    A file has ``reads_`` and ``level_`` columns and a bit of ``files``, set where
    it holds the site. Rows are dealt before they are folded, as the files'
    columns are many more than those they come from.
    """
    site = ["contig", "start"]
    used = "l_quantity l_extendedprice l_discount l_tax l_returnflag l_linestatus".split()
    rows = table(spark, folder, "lineitem").selectExpr(
        "1 + l_orderkey % 22 AS contig", "l_orderkey*50 + l_linenumber*7 AS start", *used
    )
    folds, bits, held = [], F.lit(0), F.lit(False)
    for n, name in enumerate(pileup_names(members, haplotypes)):
        where, when, level, reads = PILEUPS[name]
        here = F.expr(f"({where}) AND ({when})")
        for kind, value in (("reads", reads), ("level", level)):
            folds.append(F.max(F.when(here, F.expr(value))).alias(f"{kind}_{'_'.join(name)}"))
        bits = bits + F.when(here, F.lit(1 << n)).otherwise(F.lit(0))
        held = held | here
    folded = rows.filter(held).repartition(*site).groupBy(*site).agg(*folds, F.bit_or(bits).alias("files"))
    chrom = F.concat(F.lit("chr"), F.col("contig").cast("string")).alias("chrom")
    return folded.select(chrom, "start", (F.col("start") + 1).alias("end"), *folded.columns[2:])
