"""Flags, CIGARs, regions, SAM text, expressions: hand-made cases and a small Python model."""

import random

import pytest
from loomseq import cigar, flags, regions
from loomseq.headers import AlignmentHeader
from loomseq.operators import depth, order, pileup, reads
from loomseq.plans.alignment_expr import ExpressionError, compile_filter
from loomseq.sources import fastx, sam
from pyspark.sql import functions as F

HEADER = AlignmentHeader.from_text("@HD\tVN:1.6\n@SQ\tSN:c1\tLN:1000\n@SQ\tSN:c2\tLN:500\n@RG\tID:g1\tSM:s\tLB:l1\n@RG\tID:g2\tSM:s\tLB:l2\n@CO\tnote: a comment\n")
SAM = [
    "a1\t99\tc1\t11\t60\t5S10M2I8M\t=\t101\t115\t" + "ACGTA" * 5 + "\t" + "I" * 25 + "\tRG:Z:g1\tNM:i:2\tXF:f:0.5\tXB:B:c,1,-2,3",
    "a1\t147\tc1\t101\t60\t25M\t=\t11\t-115\t" + "TTTTT" * 5 + "\t" + "5" * 25 + "\tRG:Z:g1\tNM:i:0",
    "b7\t0\tc1\t15\t20\t10M5D10M\t*\t0\t0\t" + "GGGGG" * 4 + "\t" + "#" * 20 + "\tRG:Z:g2",
    "b12\t16\tc2\t1\t0\t4M100N6M\t*\t0\t0\tACGTACGTAC\t*",
    "u1\t4\t*\t0\t0\t*\t*\t0\t0\tNNNNN\tIIIII",
    "h1\t2048\tc1\t40\t3\t5H3M1P2M\t*\t0\t0\tACGTA\tABCDE",
]


@pytest.fixture(scope="module")
def table(spark):
    lines = spark.createDataFrame([(line, 0, i) for i, line in enumerate(SAM)], "value string, file_id int, rec_no long")
    return sam.parse(lines, HEADER).cache()


def test_flags():
    assert flags.parse("PAIRED,UNMAP") == 5 and flags.parse("0x10") == 16 and flags.parse("020") == 16 and flags.parse("99") == 99
    assert flags.names(99) == "PAIRED,PROPER_PAIR,MREVERSE,READ1"


def test_flag_columns(table):
    got = {r.qname: r for r in table.where("rec_no in (2, 4)").select("qname", flags.names_column().alias("n"), *(flags.accessor(a).alias(a) for a in flags.ACCESSORS)).collect()}
    assert got["b7"].n == "" and got["b7"].is_mapped and got["b7"].is_forward and not got["b7"].is_paired
    assert got["u1"].n == "UNMAP" and got["u1"].is_unmapped


def test_parse_and_write_are_inverse(table):
    assert [r.value for r in sam.lines(table.orderBy("rec_no")).collect()] == SAM


def test_columns(table):
    got = {
        (r.qname, r.rec_no): r
        for r in table.select(
            "qname", "rec_no", "tid", "pos", "end_pos", cigar.reference_end().alias("re"), cigar.query_length().alias("ql"), cigar.read_length().alias("rl"), cigar.query_alignment_start().alias("qs"), cigar.query_alignment_end().alias("qe"),
            cigar.blocks().alias("b"), cigar.introns().alias("i"), cigar.reference_positions().alias("p"), cigar.reference_positions(full_length=True).alias("pf"), cigar.unclipped_start().alias("us"), cigar.unclipped_end().alias("ue"), cigar.stats(nm="try_element_at(tags, 'NM').i").alias("st"),
        ).collect()
    }
    a = got["a1", 0]
    assert (a.tid, a.pos, a.end_pos, a.re, a.ql, a.qs, a.qe, a.us, a.ue) == (0, 10, 28, 28, 25, 5, 25, 5, 28)
    assert [(b.start, b.stop, b.query) for b in a.b] == [(10, 20, 5), (20, 28, 17)]
    assert len(a.p) == 18 and len(a.pf) == 25 and a.pf[:6] == [None] * 5 + [10]
    assert a.st.bases == [18, 2, 0, 0, 5, 0, 0, 0, 0, 0, 2] and a.st.blocks[:5] == [2, 1, 0, 0, 1]
    assert [(i.start, i.stop) for i in got["b12", 3].i] == [(4, 104)]
    u = got["u1", 4]
    assert u.re is None and u.end_pos == 0 and u.b is None
    h = got["h1", 5]
    assert (h.ql, h.rl, h.us) == (5, 10, 34)


def test_padding_advances_the_query_of_pairs(table):
    pairs = table.where("qname = 'h1'").select(cigar.aligned_pairs().alias("p")).first().p
    assert [(p.query, p.ref) for p in pairs] == [(0, 39), (1, 40), (2, 41), (3, None), (4, 42), (5, 43)]


def test_random_cigars_against_a_model(spark):
    rng = random.Random(1)
    rows = []
    for i in range(150):
        ops = [(rng.choice("MIDN=X"), rng.randrange(1, 9)) for _ in range(rng.randrange(1, 7))]
        if rng.random() < 0.5:
            ops = [("S", rng.randrange(1, 4)), *ops]
        if rng.random() < 0.3:
            ops = [("H", 2), *ops, ("S", 3)]
        rows.append((i, rng.randrange(1000), "".join(f"{n}{o}" for o, n in ops)))
    df = spark.createDataFrame(rows, "i int, pos long, cigar string").withColumn("cigar_ops", cigar.parse())
    got = df.select("i", "pos", "cigar", cigar.text().alias("t"), cigar.reference_length().alias("rl"), cigar.aligned_pairs(matches_only=True).alias("m"), cigar.overlap(100, 500).alias("o")).collect()
    import re

    for r in got:
        assert r.t == r.cigar
        ref, query, pairs = r.pos, 0, []
        for n, op in re.findall(r"(\d+)(.)", r.cigar):
            for _ in range(int(n)):
                if op in "M=X":
                    pairs.append((query, ref))
                query += op in "MIS=X"
                ref += op in "MDN=X"
        assert r.rl == ref - r.pos and [(p.query, p.ref) for p in r.m] == pairs
        assert r.o == sum(100 <= p < 500 for _, p in pairs)


@pytest.mark.parametrize(
    "text, expected",
    [("c1", ("c1", 0, regions.MAX_POS)), ("c1:10", ("c1", 9, regions.MAX_POS)), ("c1:1,001-2,000", ("c1", 1000, 2000)), ("c1:-50", ("c1", 0, 50)), ("*", ("*", 0, regions.MAX_POS)), (".", (None, 0, regions.MAX_POS)), ("HLA:01:02", ("HLA:01", 1, regions.MAX_POS))],
)
def test_region_text(text, expected):
    r = regions.parse_region(text)
    assert (r.contig, r.start, r.stop) == expected


@pytest.mark.parametrize("kw", [{"region": "c1:20-10"}, {"contig": "c1", "start": 5, "stop": 2}, {"start": 5}, {"contig": "c1", "start": -1}, {"contig": "x", "lengths": {"c1": 5}}, {"region": "c1", "contig": "c1"}])
def test_bad_regions(kw):
    with pytest.raises(ValueError):
        regions.parse_region(**kw)


def test_fetch(table):
    assert sorted(r.rec_no for r in reads.fetch(table, "c1:20-30").collect()) == [0, 2]
    assert sorted(r.rec_no for r in reads.fetch(table, contig="c1", start=28, stop=29).collect()) == [2]
    assert reads.fetch(table).count() == 5 and reads.fetch(table, until_eof=True).count() == 6 and reads.fetch(table, "*").count() == 1
    assert depth.count(table, "c1:1-200") == 4 and depth.count(table, "c1:1-200", "all") == 4


def test_bins_and_interval_joins_against_all_pairs(spark):
    rng = random.Random(2)
    make = lambda n: [(i, rng.choice("xy"), s := rng.randrange(100_000), s + rng.choice([1, 50, 20_000, 60_000])) for i in range(n)]
    a, b = make(60), make(40)
    left, right = spark.createDataFrame(a, "i int, c string, s long, e long"), spark.createDataFrame(b, "j int, c2 string, s2 long, e2 long")
    hit = {(x[0], y[0]) for x in a for y in b if x[1] == y[1] and x[2] < y[3] and y[2] < x[3]}
    on = ("c", "s", "e"), ("c2", "s2", "e2")
    assert {(r.i, r.j) for r in regions.interval_join(left, right, *on).collect()} == hit
    assert regions.interval_join(left, right, *on).count() == len(hit)
    some = {i for i, _ in hit}
    assert sorted(r.i for r in regions.interval_join(left, right, *on, how="left_semi").collect()) == sorted(some)
    assert sorted(r.i for r in regions.interval_join(left, right, *on, how="left_anti").collect()) == sorted({x[0] for x in a} - some)
    outer = [(r.i, r.j) for r in regions.interval_join(left, right, *on, how="left_outer").collect()]
    assert sorted(outer, key=str) == sorted([*hit, *((x[0], None) for x in a if x[0] not in some)], key=str)


def test_interval_algebra(spark):
    df = lambda rows: spark.createDataFrame(rows, "contig string, start long, stop long")
    a, b = df([("c", 0, 10), ("c", 5, 20), ("c", 30, 40), ("d", 1, 2)]), df([("c", 8, 12), ("c", 35, 50)])
    rows = lambda d: sorted((r.contig, r.start, r.stop) for r in d.collect())
    assert rows(regions.merge_intervals(a)) == [("c", 0, 20), ("c", 30, 40), ("d", 1, 2)]
    assert rows(regions.intersect_intervals(a, b)) == [("c", 8, 12), ("c", 35, 40)]
    assert rows(regions.subtract_intervals(a, b)) == [("c", 0, 8), ("c", 12, 20), ("c", 30, 35), ("d", 1, 2)]


@pytest.mark.parametrize(
    "text, expected",
    [
        ("mapq >= 20", [0, 1, 2]),
        ("[NM]", [0]),
        ("exists([NM])", [0, 1]),
        ("default([NM], 9) > 1", [0, 2, 3, 4, 5]),
        ("!exists([RG])", [3, 4, 5]),
        ('[RG] == "g1" && flag.read2', [1]),
        ('rname =~ "^c" && qname !~ "^a"', [2, 3, 5]),
        ("flag & 16", [1, 3]),
        ("pos % 2 == 1 && pos > 0", [0, 1, 2, 3]),
        ("length(seq) == 25 || ncigar == 3", [0, 1, 2, 3]),
        ("sclen + hclen > 4", [0, 5]),
        ("avg(qual) < 3 && avg(qual) >= 2", [2]),
        ("max(qual) - min(qual) == 4", [5]),
        ("-1 + 2 * 3 == 5 && (1 | 2 ^ 2) == 1", [0, 1, 2, 3, 4, 5]),
        ("endpos == 28", [0]),
        ("pos % 0 == 0", []),
    ],
)
def test_alignment_expressions(table, text, expected):
    assert sorted(r.rec_no for r in table.where(compile_filter(text)).collect()) == expected


@pytest.mark.parametrize("text", ["mapq >", "nothing == 1", "foo(1)", "(mapq", "mapq 5"])
def test_bad_alignment_expressions(text):
    with pytest.raises(ExpressionError):
        compile_filter(text)


def test_view_rules(table):
    ids = lambda **kw: sorted(r.rec_no for r in reads.view(table, **kw).collect())
    assert ids(read_groups=["g1"]) == [0, 1, 3, 4, 5] and ids(read_groups=["g1"], without_group=False) == [0, 1]
    assert ids(min_qlen=25) == [0, 1] and ids(tag_filter=("NM", ["0"])) == [1] and ids(tag_filter=("XF", None)) == [0]
    assert ids(require="PAIRED", exclude_all=0x41) == [1] and ids(exclude="PAIRED,UNMAP", invert=True) == [0, 1, 4]
    assert ids(library="l2", header_groups=HEADER.read_groups(table.sparkSession)) == [2]
    assert ids(names=["b7", "u1"]) == [2, 4]


def test_subsample_keeps_templates_whole(spark):
    df = spark.createDataFrame([(f"q{i // 2}",) for i in range(2000)], "qname string")
    kept = [r.qname for r in reads.subsample(df, 0.3, 5).collect()]
    assert 450 < len(kept) < 750 and all(kept.count(q) == 2 for q in set(kept))
    hashes = {r.qname: r.h for r in df.distinct().select("qname", reads.mixed(reads.name_hash()).alias("h")).collect()}

    def model(name):
        h = 0
        for c in name:
            h = (h * 31 + ord(c)) & 0xFFFFFFFF
        m = 0xFFFFFFFF
        h = (h + (~(h << 15) & m)) & m
        h ^= h >> 10
        h = (h + (h << 3)) & m
        h ^= h >> 6
        h = (h + (~(h << 11) & m)) & m
        return h ^ h >> 16

    assert all(hashes[q] == model(q) for q in hashes)


def test_tags_and_edits(table):
    out = reads.set_tag(table, "XX", F.lit(7), "i")
    assert out.where("rec_no = 0").select(reads.tag("XX")["i"].alias("v")).first().v == 7
    assert reads.set_tag(table, "NM", None).where(reads.tag("NM").isNotNull()).count() == 0
    assert reads.edit_flags(table, add="DUP", remove=1).where("rec_no = 0").first().flag == 99 - 1 + 1024
    fq = {(r.name, r.part): r for r in reads.fastq(table).collect()}
    assert fq["a1/2", "2"].seq == "AAAAA" * 5 and ("u1", "0") in fq


def test_depth_and_coverage_against_a_count(table):
    got = {(r.rname, r.pos): r.depth for r in depth.depth(table).collect()}
    model = {}
    for r in table.where(flags.lacks(flags.EXCLUDED)).select("rname", cigar.reference_positions().alias("p")).collect():
        for p in r.p or []:
            model[r.rname, p] = model.get((r.rname, p), 0) + 1
    assert got == model
    with_gaps = {(r.rname, r.pos): r.depth for r in depth.depth(table, deletions=True).collect()}
    assert with_gaps["c1", 26] == model["c1", 26] + 1
    assert {(r.rname, r.pos): r.depth for r in depth.depth(table, min_baseq=1).collect()}.keys() <= got.keys()


def test_depth_tiles_carry_over(spark, monkeypatch):
    monkeypatch.setattr(depth, "TILE_SHIFT", 3)
    rng = random.Random(3)
    spans = [("c", s := rng.randrange(200), s + rng.randrange(1, 90)) for _ in range(40)]
    runs = depth.runs(spark.createDataFrame(spans, "rname string, start long, stop long")).collect()
    got = {p: r.depth for r in runs for p in range(r.start, r.stop)}
    assert got == {p: n for p in range(300) if (n := sum(s <= p < e for _, s, e in spans))}


def test_natural_names(spark):
    names = ["a7", "a12", "a007b", "b1", "a7c", "A1", "a", "10", "9"]
    got = [r.qname for r in spark.createDataFrame([(n,) for n in names], "qname string").orderBy(order.natural_key()).collect()]
    assert got == ["9", "10", "A1", "a", "a7", "a007b", "a7c", "a12", "b1"]


def test_coordinate_sort_puts_unplaced_last(table):
    assert [r.rec_no for r in order.sort_reads(table).collect()] == [0, 2, 5, 1, 3, 4]


def pair(name, p1, p2, q="I", flag1=99, flag2=147):
    return [f"{name}\t{flag1}\tc1\t{p1}\t60\t10M\t=\t{p2}\t{p2 + 10 - p1}\tACGTACGTAC\t{q * 10}", f"{name}\t{flag2}\tc1\t{p2}\t60\t10M\t=\t{p1}\t{p1 - p2 - 10}\tACGTACGTAC\t{q * 10}"]


def test_duplicates(spark):
    lines = [*pair("p1", 100, 200), *pair("p2", 100, 200, "5"), *pair("p3", 100, 200), *pair("p4", 100, 210), "s1\t0\tc1\t100\t60\t10M\t*\t0\t0\tACGTACGTAC\t" + "J" * 10, "s2\t0\tc1\t300\t60\t2S8M\t*\t0\t0\tACGTACGTAC\t" + "J" * 10, "s3\t0\tc1\t298\t60\t10M\t*\t0\t0\tACGTACGTAC\t" + "I" * 10]
    df = sam.parse(spark.createDataFrame([(v, 0, i) for i, v in enumerate(lines)], "value string, file_id int, rec_no long"), HEADER)
    marked = order.mark_duplicates(df)
    assert {r.qname for r in marked.where(flags.has(0x400)).collect()} == {"p2", "p3", "s1", "s3"}
    assert order.mark_duplicates(df, remove=True).count() == len(lines) - 6


def test_mates_are_fixed(spark):
    lines = ["m\t65\tc1\t100\t60\t10M\t*\t0\t0\tACGTACGTAC\tIIIIIIIIII", "m\t145\tc1\t150\t40\t10M\t*\t0\t0\tACGTACGTAC\tIIIIIIIIII", "n\t73\tc2\t5\t60\t10M\t*\t0\t0\tACGTACGTAC\tIIIIIIIIII", "n\t133\t*\t0\t0\t*\t*\t0\t0\tACGTACGTAC\tIIIIIIIIII"]
    df = sam.parse(spark.createDataFrame([(v, 0, i) for i, v in enumerate(lines)], "value string, file_id int, rec_no long"), HEADER)
    got = {r.rec_no: r for r in order.fix_mates(df, add_score=True).collect()}
    assert (got[0].flag, got[0].mate_pos, got[0].tlen, got[0].tags["MQ"].i, got[0].tags["MC"].s, got[0].tags["ms"].i) == (65 | 2 | 32, 149, 60, 40, "10M", 400)
    assert (got[1].flag, got[1].mate_pos, got[1].tlen) == (147, 99, -60)
    assert got[2].flag & 8 and got[3].rname == "c2" and got[3].pos == 4 and got[2].mate_pos == 4


def test_flagstat_and_index_statistics(table):
    row = {r.qc: r for r in depth.flagstat(table).collect()}["pass"]
    assert (row.total, row.mapped, row.paired, row.properly_paired, row.supplementary, row.mapped_share) == (6, 5, 2, 2, 1, "83.33%")
    got = {r.name: (r.mapped, r.unmapped) for r in depth.index_statistics(table, HEADER.contigs(table.sparkSession)).collect()}
    assert got == {"c1": (4, 0), "c2": (1, 0), "*": (0, 1)}


def test_pileup_states(table):
    rows = {r.pos: r for r in pileup.pileup_bases(table.where("rec_no = 2"), "all").collect()}
    assert rows[14].is_head and rows[38].is_tail and rows[23].indel == -5 and rows[24].is_del and rows[24].query is None and rows[24].query_or_next == 10
    ins = {r.pos: r for r in pileup.pileup_bases(table.where("rec_no = 0"), "all").collect()}
    assert (ins[19].indel, ins[19].insert) == (2, "AC")
    text = {r.pos: r for r in pileup.mpileup(pileup.pileup_bases(table.where("rec_no in (0, 2)"), "all"), min_base_quality=0).collect()}
    assert text[14].bases == "A^5G" and text[23].bases == "AG-5NNNNN" and text[24].bases == "C*"


def test_overlapping_mates_count_once(spark):
    df = sam.parse(spark.createDataFrame([(v, 0, i) for i, v in enumerate(pair("o", 100, 105))], "value string, file_id int, rec_no long"), HEADER)
    rows = pileup.pileup_bases(df).where("pos = 105").collect()
    assert sorted(r.q for r in rows) == ([0, 32] if rows[0].base != rows[1].base else [0, 80])


def test_header_round_trip():
    assert str(HEADER) == str(AlignmentHeader.from_dict(HEADER.to_dict()))
    assert HEADER.references == ("c1", "c2") and HEADER.get_tid("c2") == 1 and HEADER.get_tid("zz") == -1 and HEADER.get_reference_length("c2") == 500
    with pytest.raises(KeyError):
        HEADER.get_reference_length("zz")
    assert AlignmentHeader.from_references(["x"], [5]).to_dict() == {"SQ": [{"SN": "x", "LN": 5}]}


def test_plain_sequence_files_are_read_in_pieces(spark, tmp_path):
    rng = random.Random(3)
    seq = lambda n: "".join(rng.choice("ACGT") for _ in range(n))
    fasta = [(f"c{i} x", seq(rng.randrange(0, 400))) for i in range(50)]
    fastq = [(f"r{i}", s := seq(rng.randrange(1, 60)), "".join(rng.choice("@+>I") for _ in s)) for i in range(300)]
    (tmp_path / "a.fa").write_text("".join(f">{n}\n" + "".join(s[k : k + 60] + "\n" for k in range(0, len(s), 60)) for n, s in fasta))
    (tmp_path / "b.fq").write_text("".join(f"@{n}\n{s}\n+\n{q}\n" for n, s, q in fastq))
    for size in (100, 777, 5000):
        got = fastx.read(spark, str(tmp_path / "a.fa"), split_bytes=size)
        assert sorted((r.name, r.seq) for r in got.collect()) == sorted((n.split()[0], s) for n, s in fasta)
        got = fastx.read(spark, str(tmp_path / "b.fq"), four_lines=True, split_bytes=size)
        assert got.rdd.getNumPartitions() > 1
        assert sorted((r.name, r.seq, r.qual) for r in got.collect()) == sorted(fastq)


def test_a_region_of_a_laid_out_table_prunes(spark, table, tmp_path):
    from loomseq.sources import laid

    laid.write(table, str(tmp_path / "laid"), files=2)
    got = reads.fetch(laid.read(spark, str(tmp_path / "laid")), contig="c1", start=10, stop=20)
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "LessThan(pos,20)" in plan and "GreaterThan(end_pos,10)" in plan
    assert sorted(r.rec_no for r in got.collect()) == sorted(r.rec_no for r in reads.fetch(table, contig="c1", start=10, stop=20).collect())
