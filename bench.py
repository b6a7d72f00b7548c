"""Times the headline operators and jobs; prints one JSON line.

The inputs (site tables, SNVs, blocks) are derived from the driver tables and
written once, untimed; each query then runs from those files to a sink that
computes every row. The best of ``BENCH_RUNS`` runs (default 2) counts.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from checks.registry import BIN, MEMBERS, Inputs  # noqa: E402
from haplometh.operators import expand, hapmap, intervals, joins, methylation, phasing, qc  # noqa: E402
from haplometh.session import local_session  # noqa: E402
from haplometh.sinks import text  # noqa: E402
from haplometh.sources import genome  # noqa: E402
from haplometh.storage import shared_folder  # noqa: E402

FOLDER = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
RUNS = int(os.environ.get("BENCH_RUNS", "2"))


class Staged(Inputs):
    """Inputs whose every view is read from a file written beforehand."""

    def view(self, name):
        return self.step(name, lambda: Inputs.view(self, name))


def consume(df):
    df.write.format("noop").mode("overwrite").save()


def queries(i: Staged) -> dict:
    files = {(m, h): i.pileup("kid", m, h) for m in methylation.MODES for h in ("hap1", "hap2")}
    founder = i.step("founder-phased", i.founder)
    parents = i.step("parent-phased", i.parents)
    count = i.step("kid-count", lambda: i.haplotypes("kid", "count"))
    model = i.step("kid-model", lambda: i.haplotypes("kid", "model"))
    phased = {
        m: i.step(f"kid-{m}-phased", lambda df=df: methylation.phase_to_founders(df, i.hap_map(), bin_size=BIN))
        for m, df in (("count", count), ("model", model))
    }
    near = i.step("near", lambda: i.near().drop(intervals.WORD))
    near_trio = i.step("near-trio", lambda: i.near_trio().drop(intervals.WORD))
    unphased = {(p, m): i.combined(p, m) for p in MEMBERS for m in methylation.MODES}
    variants = i.step("variants", i.variants)
    trio_variants = i.step("trio-variants", i.trio_variants)
    founder_sides = i.view("fx_read"), i.read_blocks(), i.view("fx_iht"), i.view("fx_iht_block")
    snvs, hap_map, mismatches = i.founder_snvs(), i.hap_map(), i.mismatches()
    sites = i.view("fx_cpg")
    maps = i.parent_map("dad"), i.parent_map("mom")
    spec = hapmap.founder_spec()
    out = f"{shared_folder(i.spark)}/bench"

    def final():
        return expand.flag_allele_specific(near, variants)

    return {
        "j2_j4_founder_snvs": lambda: consume(phasing.founder_phasing(*founder_sides, bin_size=BIN)),
        "a2_hap_map": lambda: consume(hapmap.hap_map(snvs, spec)),
        "a5_mismatch_sites": lambda: consume(hapmap.mismatch_sites(snvs, spec)),
        "j1_full_outer_haps": lambda: consume(i.haplotypes("kid", "count")),
        "j6_cpg_hapmap_left": lambda: consume(methylation.phase_to_founders(count, hap_map, bin_size=BIN)),
        "j8_null_safe_full": lambda: consume(methylation.combine_modes(phased["count"], phased["model"])),
        "e1_founder_phasing": lambda: consume(methylation.founder_phased_methylation(files, hap_map, bin_size=BIN)),
        "j11_trio_alignment": lambda: consume(i.trio_sites()),
        "e2_parent_phasing": lambda: consume(methylation.phase_to_parents(i.trio_sites(), *maps, bin_size=BIN)),
        "j12_all_sites": lambda: consume(
            expand.all_sites_founder(i.view("fx_reference"), unphased["kid", "count"], unphased["kid", "model"])
        ),
        "j12_all_sites_trio": lambda: consume(expand.all_sites_trio(i.view("fx_reference"), unphased)),
        "j14_within_50": lambda: consume(expand.flag_proximity(sites, mismatches)),
        "j14_nearest_distance": lambda: consume(intervals.nearest(sites, mismatches)),
        "j15_w1_snv_overlap": lambda: consume(expand.label_with_variants(sites, variants)),
        "a6_allele_specific": lambda: consume(final()),
        "a7_allele_specific_trio": lambda: consume(expand.flag_allele_specific(near_trio, trio_variants, MEMBERS)),
        "a8_qc_pedigree": lambda: qc.qc_founder(expand.flag_proximity(founder_all(i), hapmap.het_sites(snvs))).collect(),
        "j17_created": lambda: consume(joins.created_sites(unphased["kid", "count"], i.view("fx_reference"))),
        "k1_write_bed": lambda: text.write_bed(founder, out, "founder"),
        "k7_write_founder_tracks": lambda: text.write_tracks(text.tracks(founder, text.founder_track_columns()), f"{out}/tracks"),
        "k7_write_trio_tracks": lambda: text.write_tracks(
            text.tracks(parents, text.trio_track_columns({m: m for m in MEMBERS})), f"{out}/trio-tracks"
        ),
        "k8_write_methylation": lambda: text.write_methylation(i.step("final", final), f"{out}/final.bed", "bench"),
        "s14_cpg_scan": lambda: consume(genome.cpg_sites(i.view("fx_sequence"))),
    }


def founder_all(i: Staged):
    return i.step("expanded", lambda: i.expanded().drop(intervals.WORD))


def main() -> None:
    spark = local_session(CPUS, "bench")
    start = time.perf_counter()
    staged = Staged(spark, FOLDER, staged=True)
    timed = queries(staged)
    setup = time.perf_counter() - start
    seconds = {}
    for name, run in timed.items():
        best = None
        for _ in range(RUNS):
            start = time.perf_counter()
            run()
            took = time.perf_counter() - start
            best = took if best is None else min(best, took)
        seconds[name] = round(best, 3)
    scale = os.path.basename(FOLDER.rstrip("/")).removeprefix("sf")
    line = {
        "metric": "total_query_seconds",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": float(scale) if scale.replace(".", "", 1).isdigit() else scale,
        "setup_sec": round(setup, 1),
        "cpg_sites": staged.view("fx_cpg").count(),
    }
    print(json.dumps(line))
    spark.stop()


if __name__ == "__main__":
    main()
