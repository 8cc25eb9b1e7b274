"""Sequential models: hidden Markov chains over sites, and what is made of a contig in one pass.

A chain runs over the sites of one sample and contig in order, so these go
through ``applyInPandas`` by that key; a group is a contig's sites of a sample.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def viterbi(log_start: np.ndarray, log_step: np.ndarray, log_emit: np.ndarray) -> np.ndarray:
    """The likeliest states; ``log_step`` is (sites, from, to), its first row unused."""
    n, k = log_emit.shape
    score, back = log_start + log_emit[0], np.zeros((n, k), np.int64)
    for i in range(1, n):
        reach = score[:, None] + log_step[i]
        back[i] = reach.argmax(0)
        score = reach.max(0) + log_emit[i]
    path = np.zeros(n, np.int64)
    path[-1] = score.argmax()
    for i in range(n - 1, 0, -1):
        path[i - 1] = back[i, path[i]]
    return path


def posteriors(start: np.ndarray, step: np.ndarray, emit: np.ndarray) -> np.ndarray:
    """State probabilities per site by the forward and backward passes, scaled at each site."""
    n, k = emit.shape
    forward, backward = np.zeros((n, k)), np.ones((n, k))
    forward[0] = start * emit[0]
    forward[0] /= forward[0].sum()
    for i in range(1, n):
        forward[i] = (forward[i - 1] @ step[i]) * emit[i]
        forward[i] /= forward[i].sum()
    for i in range(n - 2, -1, -1):
        backward[i] = step[i + 1] @ (emit[i + 1] * backward[i + 1])
        backward[i] /= backward[i].sum()
    out = forward * backward
    return out / out.sum(1, keepdims=True)


def runs_of_homozygosity(genotypes: DataFrame, to_roh: float = 6.7e-8, to_normal: float = 5e-9, error: float = 1e-3, rate: float = 1e-8) -> DataFrame:
    """(sample, chrom, start, stop, sites, quality): runs whose genotypes lack heterozygotes.

    ``genotypes``: (sample, chrom, pos, dosage 0-2 or null, af). Outside a run a
    site is heterozygous as its allele frequency says, inside only by error; the
    chance to change state grows with the distance between sites.
    """

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.dropna(subset=["dosage", "af"]).sort_values("pos")
        names = ["sample", "chrom", "start", "stop", "sites", "quality"]
        if not len(rows):
            return pd.DataFrame(columns=names)
        pos, dose, p = rows["pos"].to_numpy(), rows["dosage"].to_numpy(int), rows["af"].clip(1e-4, 1 - 1e-4).to_numpy()
        hw = np.stack([(1 - p) ** 2, 2 * p * (1 - p), p**2])
        roh = np.stack([(1 - p) * (1 - error), np.full(len(p), error), p * (1 - error)])
        at = np.arange(len(p))
        emit = np.stack([hw[dose, at], roh[dose, at]], 1)
        gap = np.r_[0, np.diff(pos)]
        enter, leave = -np.expm1(-gap * to_roh), -np.expm1(-gap * to_normal)
        step = np.stack([np.stack([1 - enter, enter], 1), np.stack([leave, 1 - leave], 1)], 1)
        start = np.array([0.99, 0.01])
        with np.errstate(divide="ignore"):
            states = viterbi(np.log(start), np.log(step), np.log(emit))
        sure = posteriors(start, step, emit)[:, 1]
        edge = np.flatnonzero(np.diff(np.r_[0, states, 0]))
        out = [(rows["sample"].iloc[0], rows["chrom"].iloc[0], int(pos[a]) - 1, int(pos[b - 1]), int(b - a), float(-10 * np.log10(max(1e-10, 1 - sure[a:b].mean())))) for a, b in zip(edge[::2], edge[1::2])]
        return pd.DataFrame(out, columns=names)

    return genotypes.groupBy("sample", "chrom").applyInPandas(run, "sample string, chrom string, start long, stop long, sites long, quality double")


def dosages(variants: DataFrame) -> DataFrame:
    """(sample, chrom, pos, dosage, af) of biallelic sites."""
    from ..sources.vcf import genotypes
    from .variants import allele_counts

    rows = genotypes(allele_counts(variants.where("size(alts) = 1")))
    missing = F.col("gt").isNull() | F.exists("gt.alleles", lambda a: a.isNull())
    return rows.select("sample", "chrom", "pos", F.when(~missing, F.aggregate("gt.alleles", F.lit(0), lambda t, a: t + a)).cast("double").alias("dosage"), F.get("af", F.lit(0)).alias("af"))


def target_regions(runs: DataFrame, low: float = 1.0, high: float = 20.0, stay: float = 0.999) -> DataFrame:
    """(contig, start, stop): stretches of high coverage by a two-state chain over runs of equal depth (rname, start, stop, depth)."""
    import math

    def cut(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("start")
        starts, stops, depths = (rows[c].to_numpy(float) for c in ("start", "stop", "depth"))
        # Gaps are runs of depth zero.
        spans = []
        at = 0.0
        for s, e, d in zip(starts, stops, depths):
            if s > at:
                spans.append((at, s, 0.0))
            spans.append((s, e, d))
            at = e
        spans_ = np.array(spans)
        width, d = spans_[:, 1] - spans_[:, 0], spans_[:, 2]
        poisson = lambda m: d * math.log(m) - m
        emit = np.stack([poisson(low), poisson(high)], 1) * width[:, None]
        change = np.log(np.clip(1 - stay ** width, 1e-12, 1 - 1e-12))
        keep = np.log(np.clip(stay ** width, 1e-12, 1))
        step = np.stack([np.stack([keep, change], 1), np.stack([change, keep], 1)], 1)
        states = viterbi(np.log([0.5, 0.5]), step, emit)
        edge = np.flatnonzero(np.diff(np.r_[0, states, 0]))
        out = [(rows["rname"].iloc[0], int(spans_[a, 0]), int(spans_[b - 1, 1])) for a, b in zip(edge[::2], edge[1::2])]
        return pd.DataFrame(out, columns=["contig", "start", "stop"])

    return runs.groupBy("rname").applyInPandas(cut, "contig string, start long, stop long")


def apply_variants(fasta: DataFrame, variants: DataFrame, haplotype: str = "alt", mask: DataFrame | None = None, mask_with: str = "N") -> DataFrame:
    """(name, seq): each contig with its variants put in, from the left; a variant that overlaps one put in before is left out.

    ``haplotype``: ``alt`` the first alternate, ``1``/``2`` the allele at that
    place of the first sample's genotype, ``I`` ambiguity letters for
    heterozygous substitutions. ``mask``: (contig, start, stop) written as
    ``mask_with`` first.
    """
    from .pileup import AMBIGUITY

    pairs = {frozenset(v): k for k, v in AMBIGUITY.items() if len(v) == 2}
    sites = variants.select(F.col("chrom").alias("name"), "start", "ref", "alts", F.get("samples", F.lit(0))["gt"]["alleles"].alias("gt"))

    def put(key, sequences: pd.DataFrame, rows: pd.DataFrame) -> pd.DataFrame:
        if not len(sequences):
            return pd.DataFrame(columns=["name", "seq"])
        seq = sequences["seq"].iloc[0]
        out, at = [], 0
        for start, ref, alts, gt in rows.sort_values(["start", "ref"])[["start", "ref", "alts", "gt"]].itertuples(index=False):
            alleles = [ref, *alts]
            called = [a for a in gt if a is not None and a == a] if gt is not None else []
            if haplotype == "alt":
                chosen = alleles[1] if len(alleles) > 1 else ref
            elif haplotype == "I":
                letters = frozenset(alleles[int(a)].upper() for a in called)
                chosen = pairs.get(letters, alleles[int(max(called))]) if called else ref
            else:
                k = int(haplotype) - 1
                chosen = alleles[int(called[k])] if k < len(called) else ref
            if start < at or chosen == ref or chosen[:1] in "<*" or seq[start : start + len(ref)].upper() != ref.upper():
                continue
            out += [seq[at:start], chosen]
            at = start + len(ref)
        return pd.DataFrame([(key[0], "".join([*out, seq[at:]]))], columns=["name", "seq"])

    masked = fasta
    if mask is not None:
        spans = mask.groupBy(F.col("contig").alias("name")).agg(F.array_sort(F.collect_list(F.struct("start", "stop"))).alias("m"))
        cover = F.expr(f"if(m is null, seq, aggregate(m, seq, (s, x) -> concat(left(s, cast(x.start as int)), repeat('{mask_with}', cast(least(x.stop, length(s)) - x.start as int)), substring(s, cast(x.stop as int) + 1))))")
        masked = fasta.join(spans, "name", "left").withColumn("seq", cover).select(*fasta.columns)
    return masked.select("name", "seq").groupBy("name").cogroup(sites.groupBy("name")).applyInPandas(put, "name string, seq string")
