"""Variant text, the variant expression language, set operations, normal forms, models."""

import random

import numpy as np

import pytest
from loomseq.functions import md, numeric
from loomseq.headers import VariantHeader
from loomseq.operators import models, variants
from loomseq.plans.query_format import query
from loomseq.plans.variant_expr import ExpressionError, compile_expression
from loomseq.sources import bgzf, fastx, intervals, vcf
from pyspark.sql import functions as F

TEXT = """##fileformat=VCFv4.2
##FILTER=<ID=q10,Description="Quality below 10, or so">
##INFO=<ID=DP,Number=1,Type=Integer,Description="Depth">
##INFO=<ID=AF,Number=A,Type=Float,Description="Frequency">
##INFO=<ID=DB,Number=0,Type=Flag,Description="Known">
##INFO=<ID=AA,Number=1,Type=String,Description="Ancestral">
##FORMAT=<ID=GT,Number=1,Type=String,Description="Genotype">
##FORMAT=<ID=DP,Number=1,Type=Integer,Description="Depth">
##FORMAT=<ID=PL,Number=G,Type=Integer,Description="Likelihoods">
##FORMAT=<ID=AD,Number=R,Type=Integer,Description="Allele depths">
##contig=<ID=20,length=62435964>
##contig=<ID=21>
#CHROM\tPOS\tID\tREF\tALT\tQUAL\tFILTER\tINFO\tFORMAT\tA\tB\tC
"""
LINES = [
    "20\t100\trs1\tG\tA\t29\tPASS\tDP=14;AF=0.5;DB\tGT:DP:PL:AD\t0|0:1:0,3,30:5,0\t1|0:8:30,0,30:4,4\t1/1:5:.:0,5",
    "20\t173\t.\tT\tA\t3\tq10\tDP=11;AF=0.017\tGT:DP\t0|0:3\t0|1:5\t./.:.",
    "20\t200\trs6;x\tA\tG,T\t67.5\tPASS\tDP=10;AF=0.333,0.667;AA=T\tGT:DP:PL:AD\t1|2:21:1,2,3,4,5,6:0,9,12\t2|1:2:6,5,4,3,2,1:1,1,1\t2/2:4:.:.",
    "20\t230\t.\tT\t.\t47\t.\tDP=13\tGT:DP\t0|0:54\t0|0:48\t0/0:61",
    "21\t234\tmicro\tGTC\tG,GTCT\t50\tPASS\tDP=9\tGT:DP\t0/1:35\t0/2:17\t1/1:40",
]
HEADER = VariantHeader.from_text(TEXT)


def table(spark, lines, file_id=0):
    return vcf.parse(spark.createDataFrame([(v, file_id, i) for i, v in enumerate(lines)], "value string, file_id int, rec_no long"), HEADER)


@pytest.fixture(scope="module")
def sites(spark):
    return table(spark, LINES).cache()


def test_round_trip(sites):
    assert [r.value for r in vcf.lines(sites.orderBy("rec_no")).collect()] == LINES
    assert str(VariantHeader.from_text(str(HEADER))) == str(HEADER) and HEADER.filters["q10"] == "Quality below 10, or so" and HEADER.samples == ["A", "B", "C"]


def test_fields(sites):
    r = sites.where("rec_no = 2").select("*", vcf.info("AF", HEADER).alias("af"), vcf.info("DB", HEADER).alias("db"), vcf.info("DP", HEADER).alias("dp")).first()
    assert (r.rid, r.start, r.stop, r.alts, r.qual, r.af, r.db, r.dp) == (0, 199, 200, ["G", "T"], 67.5, [0.333, 0.667], False, 10)
    assert r.samples[0].gt.alleles == [1, 2] and r.samples[0].gt.phased and not r.samples[2].gt.phased
    assert sites.where("rec_no = 1").first().samples[2].gt.alleles == [None, None]
    assert vcf.parse(sites.sparkSession.createDataFrame([(LINES[0], 0, 0)], "value string, file_id int, rec_no long"), HEADER, samples=["C"]).first().samples[0].name == "C"


@pytest.mark.parametrize(
    "text, expected",
    [
        ("QUAL>30", [2, 3, 4]),
        ("DP>=11 && QUAL<40", [0, 1]),
        ("AF=0.017", [1]),
        ("AF[1]>0.5", [2]),
        ("AF>0.4", [0, 2, 4]),
        ('FILTER="PASS"', [0, 2, 4]),
        ('FILTER!="PASS"', [1, 3]),
        ('FILTER~"q10"', [1]),
        ('FILTER="."', [3]),
        ('ID="."', [1, 3]),
        ('ID!="."', [0, 2, 4]),
        ('TYPE="snp"', [0, 1, 2]),
        ('TYPE="indel"', [4]),
        ('TYPE="ref"', [3]),
        ("DB=1", [0]),
        ('AA="T"', [2]),
        ('AA="."', [0, 1, 3, 4]),
        ("AA!=\".\"", [2]),
        ('REF="T" | ALT="T"', [1, 2, 3]),
        ('GT="het"', [0, 1, 2, 4]),
        ('GT="1|2"', [2]),
        ('GT="mis"', [1]),
        ('GT="alt" && QUAL<30', [0, 1]),
        ('GT="AA"', [0, 2, 4]),
        ('FMT/DP>40', [3]),
        ("FMT/DP[0]>20", [2, 3, 4]),
        ("AD[*:0]=0", [0, 2]),
        ('GT="het" & FMT/DP>30', [4]),
        ("N_ALT=2", [2, 4]),
        ("N_MISSING=1", [1]),
        ("F_MISSING<0.1", [0, 2, 3, 4]),
        ("AC=3", [0, 4]),
        ("AN=4", [1]),
        ("MAC=1", [1, 4]),
        ("ILEN=-2", [4]),
        ("ILEN>0", [4]),
        ("MAX(FMT/DP)>50", [3]),
        ("AVG(FMT/DP)=9", [2]),
        ("MEDIAN(FMT/DP)<6", [0, 1, 2]),
        ("SUM(FMT/DP)=14", [0]),
        ("STDEV(AF)>0.1", [2, 4]),
        ("COUNT(AF)=2", [2, 4]),
        ("SMPL_MAX(AD)>10", [2]),
        ("sSUM(AD)=8", [0]),
        ("ABS(-1*DP)=9", [4]),
        ("STRLEN(REF)=3", [4]),
        ("N_PASS(FMT/DP>4)>=3", [3, 4]),
        ("F_PASS(GT=\"alt\")>0.9", [2, 4]),
        ("BINOM(AD)>0.9", [0, 2]),
        ("POS%2=0 && CHROM=\"20\"", [0, 2, 3]),
        ("QUAL+DP>60", [2]),
        ("ID=@known", [0, 4]),
        ("PHRED(AF)<5", [0, 2, 4]),
    ],
)
def test_expressions(sites, text, expected):
    site, _ = compile_expression(text, HEADER, {"known": ["rs1", "micro"]})
    assert sorted(r.rec_no for r in sites.where(site).collect()) == expected


def test_sample_logic(sites):
    def passing(text, rec):
        _, samples = compile_expression(text, HEADER)
        return sites.where(f"rec_no = {rec}").select(samples.alias("s")).first().s

    assert passing('GT="het" | FMT/DP>4', 0) == [False, True, True]
    assert passing('GT="het" || FMT/DP>4', 0) == [True, True, True]
    assert passing('GT="het" & FMT/DP>7', 0) == [False, True, False]
    assert passing('GT="hom" && FMT/DP>7', 0) == [True, True, True]


@pytest.mark.parametrize("text", ["QUAL>", "FOO=1", "DP=\"x\"", "N_PASS(DP>1)", "bar(DP)"])
def test_bad_expressions(text):
    with pytest.raises(ExpressionError):
        compile_expression(text, HEADER)


def test_selectors(sites):
    ids = lambda **kw: sorted(r.rec_no for r in variants.select(sites, HEADER, **kw).collect())
    assert ids(min_alleles=3) == [2, 4] and ids(max_alleles=1) == [3] and ids(known=True) == [0, 2, 4] and ids(types=["indel"]) == [4]
    assert ids(min_ac=3) == [0, 2, 4] and ids(max_af=0.3, allele="alt1") == [1, 3] and ids(genotype_is="^miss") == [0, 2, 3, 4]
    assert ids(private=["C"]) == [] and ids(uncalled=False) == [0, 1, 2, 3, 4] and ids(filters=["PASS", "."]) == [0, 2, 3, 4] and ids(phased=True) == []
    assert sorted(r.rec_no for r in variants.fetch(sites, "20:173-200").collect()) == [1, 2]


def test_allele_bookkeeping(sites):
    got = {r.rec_no: r for r in variants.allele_counts(sites).collect()}
    assert got[2].ac == [2, 4] and got[2].an == 6 and got[3].ac == []
    one = {(r.rec_no, r.alts[0] if r.alts else None): r for r in variants.split_multiallelic(sites, HEADER).collect()}
    assert len(one) == 7
    g = one[2, "T"]
    assert [s.gt.alleles for s in g.samples] == [[0, 1], [1, 0], [1, 1]] and g.info["AF"] == "0.667"
    assert g.samples[0].fields["PL"] == "1,4,6" and g.samples[0].fields["AD"] == "0,12"
    both = {(r.chrom, r.pos): r for r in variants.join_biallelic(variants.split_multiallelic(sites.where("rec_no = 2"), HEADER)).collect()}
    assert both["20", 200].alts == ["G", "T"] and [s.gt.alleles for s in both["20", 200].samples] == [[1, 2], [2, 1], [2, 2]]


def test_trim_removes_unused(spark):
    df = table(spark, ["20\t5\t.\tA\tC,G,T\t1\t.\tAF=0.1,0.2,0.3\tGT:AD\t0/2:1,2,3,4\t2/2:4,3,2,1\t./.:."])
    r = variants.trim_alleles(df, HEADER).first()
    assert r.alts == ["G"] and r.info["AF"] == "0.2" and [s.gt.alleles for s in r.samples] == [[0, 1], [1, 1], [None, None]] and r.samples[0].fields["AD"] == "1,3"


def test_soft_filters_and_genotypes(sites):
    got = {r.rec_no: r.filters for r in variants.soft_filter(sites, HEADER, "low", exclude="QUAL<30", add=True).collect()}
    assert got == {0: ["low"], 1: ["q10", "low"], 2: ["PASS"], 3: ["PASS"], 4: ["PASS"]}
    out = {r.rec_no: r for r in variants.set_genotypes(sites, HEADER, exclude="FMT/DP<5").collect()}
    assert [s.gt.alleles for s in out[0].samples] == [[None, None], [1, 0], [1, 1]]


def test_gaps(spark):
    lines = [f"20\t{p}\t.\t{r}\t{a}\t{q}\t.\t.\tGT\t0/1\t0/0\t0/0" for p, r, a, q in [(100, "AT", "A", 10), (104, "C", "G", 50), (120, "C", "G", 50), (105, "CA", "C", 90), (300, "G", "GA", 5)]]
    df = table(spark, lines)
    assert {r.pos for r in variants.snp_gap(df, 5).where(F.array_contains("filters", "SnpGap")).collect()} == {104}
    assert {r.pos for r in variants.indel_gap(df, 5).where(F.array_contains("filters", "IndelGap")).collect()} == {100}


def test_set_operations(sites):
    a, b, c = sites.where("rec_no in (0, 1, 2)"), sites.where("rec_no in (1, 2, 3)"), sites.where("rec_no in (2, 4)")
    ids = lambda *x, **kw: sorted(r.rec_no for r in variants.isec([a, b, c], *x, **kw).collect())
    assert ids("=2") == [1] and ids("+2") == [1, 2] and ids("-1") == [0] and ids("~110") == [1] and ids() == [2] and ids(complement=True) == [0]
    assert variants.concat([a, b], remove_duplicates="none").count() == 4
    assert [r.pos for r in variants.concat([b, a], overlaps=True).collect()] == [100, 173, 173, 200, 200, 230]


def test_merge(spark):
    other = VariantHeader.from_text(TEXT.replace("\tA\tB\tC", "\tD"))
    a = table(spark, ["20\t5\tx\tA\tC\t10\tPASS\tDP=3\tGT\t0/1\t1/1\t0/0", "20\t9\t.\tGT\tG\t1\t.\tDP=1\tGT\t0/1\t0/0\t0/0"])
    b = vcf.parse(spark.createDataFrame([("20\t5\ty\tA\tG\t20\tq10\tDP=4\tGT\t0/1", 0, 0), ("20\t9\t.\tG\tGA\t7\t.\tDP=2\tGT\t1/1", 0, 1)], "value string, file_id int, rec_no long"), other)
    got = {r.pos: r for r in variants.merge([a, b], [HEADER, other], {"DP": "sum"}).collect()}
    assert got[5].alts == ["C", "G"] and got[5].qual == 20 and got[5].id == "x;y" and set(got[5].filters) == {"PASS", "q10"} and got[5].info["DP"] == "7"
    assert [s.gt.alleles for s in got[5].samples] == [[0, 1], [1, 1], [0, 0], [0, 2]]
    assert got[9].ref == "GT" and got[9].alts == ["G", "GAT"] and got[9].samples[3].gt.alleles == [2, 2]


def test_left_alignment():
    around = "GGGCACACACAGGG"
    assert variants.shift_left(8, "CAC", ["C"], around, 0)[:3] == (3, "GCA", ["G"])
    assert variants.shift_left(4, "C", ["T"], around, 0) == (4, "C", ["T"], True)
    assert variants.shift_left(4, "A", ["T"], around, 0)[3] is False
    assert variants.shift_left(4, "CAC", ["CAG"], around, 0)[:3] == (6, "C", ["G"])


def test_left_alignment_over_a_reference(spark):
    chunks = fastx.chunked(spark.createDataFrame([("20", None, "GGGCACACACAGGG", None)], "name string, comment string, seq string, qual string"))
    df = table(spark, ["20\t8\t.\tCAC\tC\t1\t.\t.", "20\t4\t.\tC\tT\t1\t.\t."])
    got = {r.pos: (r.norm_pos, r.norm_ref, r.norm_alts, r.ref_ok) for r in variants.left_align(df, chunks).collect()}
    assert got == {8: (3, "GCA", ["G"], True), 4: (4, "C", ["T"], True)}


def test_left_alignment_through_a_repeat_longer_than_the_window(spark):
    seq = "GGT" + "CA" * 3000 + "GGG"
    chunks = fastx.chunked(spark.createDataFrame([("20", None, seq, None)], "name string, comment string, seq string, qual string"))
    df = table(spark, ["20\t5902\t.\tCAC\tC\t1\t.\t.", "20\t2004\t.\tCAC\tC\t1\t.\t.", "20\t304\t.\tC\tCAC\t1\t.\t.", "20\t5904\t.\tC\tC\t1\t.\t."])
    df = df.withColumn("rec_no", F.col("pos")).where("pos <> 5902").unionByName(df.where("pos = 5902").withColumn("pos", F.lit(5904).cast("long")).withColumn("start", F.lit(5903).cast("long")).withColumn("rec_no", F.lit(1).cast("long")))
    got = {(r.pos, r.alts[0]) if len(r.ref) == 1 else r.pos: (r.norm_pos, r.norm_ref, r.norm_alts, r.ref_ok) for r in variants.left_align(df, chunks).collect()}
    assert got == {5904: (3, "TCA", ["T"], True), 2004: (3, "TCA", ["T"], True), (304, "CAC"): (3, "T", ["TCA"], True), (5904, "C"): (5904, "C", ["C"], True)}


def test_annotation(sites, spark):
    source = table(spark, ["20\t100\tnew\tG\tA\t1\t.\tAA=Q;DP=99\tGT\t0/0\t0/0\t0/0"])
    got = {r.rec_no: r for r in variants.annotate_from_variants(sites, source, ["AA"], copy_id=True, mark="+SEEN").collect()}
    assert got[0].info["AA"] == "Q" and got[0].info["DP"] == "14" and got[0].id == "new" and "SEEN" in got[0].info and "SEEN" not in got[1].info
    bed = spark.createDataFrame([("20", 90, 120, "x"), ("20", 99, 300, "y")], "contig string, start long, stop long, name string")
    joined = {r.rec_no: r.info.get("R") for r in variants.annotate_from_intervals(sites, bed, "name", "R", "append").collect()}
    assert joined == {0: "x,y", 1: "y", 2: "y", 3: "y", 4: None}
    assert variants.remove_annotations(sites, info=["*"], fmt=["DP"], ids=True).first().info == {}


def test_query_format(sites):
    rows = sites.where("rec_no = 0")
    assert query(rows, r"%CHROM:%POS0 %REF>%ALT{0} %QUAL %INFO/DP %TYPE[ %SAMPLE=%TGT(%DP,%AD{1})]\n", HEADER).first().value == "20:99 G>A 29 14 snp A=G|G(1,0) B=A|G(8,4) C=A/A(5,5)\n"
    assert query(rows, "[%SAMPLE %IUPACGT,]", HEADER, include="FMT/DP>=5").first().value == "B R,C A,"


def test_statistics_and_comparison(sites):
    sn = {r["name"]: r.value for r in variants.statistics(sites).collect()}
    assert sn["number of records"] == 5 and sn["number of SNPs"] == 3 and sn["number of indels"] == 1 and sn["number of multiallelic sites"] == 2 and (sn["transitions"], sn["transversions"]) == (2, 2)
    psc = {r["sample"]: r for r in variants.statistics(sites, "PSC").collect()}
    assert (psc["C"].missing, psc["C"].nonref_hom, psc["A"].hets) == (1, 3, 2)
    same = {r["sample"]: r for r in variants.concordance(sites, sites).collect()}
    assert same["B"].mismatch == 0 and same["B"].match == 5
    pairs = {(r.a, r.b): r for r in variants.compare_samples(sites).collect()}
    assert pairs["A", "B"].sites == 2 and pairs["A", "B"].discordance == 2


def test_reference_blocks(spark):
    df = table(spark, [f"20\t{p}\t.\tA\t.\t.\t.\tDP={d}\tGT\t0/0\t0/0\t0/0" for p, d in [(1, 5), (2, 6), (3, 25), (4, 26), (6, 27)]])
    got = sorted((r.start, r.stop, r.min_dp) for r in variants.gvcf_blocks(df, [1, 20]).collect())
    assert got == [(0, 2, 5), (2, 4, 25), (5, 6, 27)]


def test_validation(spark):
    bad = ["20\tx\t.\tA\tC\t1\t.\t.", "20\t1\t.\tZ\tC\tq\t.\t.", LINES[0], "20\t1"]
    got = {r.rec_no: r.errors for r in vcf.validation(spark.createDataFrame([(v, i) for i, v in enumerate(bad)], "value string, rec_no long")).collect()}
    assert got[0] == ["POS_NOT_NUMERICAL"] and got[1] == ["UNKNOWN_CHAR_IN_REF", "QUAL_NOT_NUMERICAL"] and got[2] == [] and "BADLY_FORMATTED_COLUMNS" in got[3]


def test_text_rows(spark, tmp_path):
    (tmp_path / "a.bed").write_text("track x\n#c\nc1\t5\t10\tn\t0.5\t+\n\nc1\t7\t9\nshort\n")
    bed = intervals.bed(intervals.lines(spark, str(tmp_path / "a.bed"))).collect()
    assert [(r.start, r.stop, r.name, r.score) for r in bed] == [(5, 10, "n", 0.5), (7, 9, None, None)]
    (tmp_path / "a.gtf").write_text('c1\ts\texon\t11\t20\t.\t-\t.\tgene_id "G 1"; exon_number 2; note "x"\n')
    g = intervals.gtf(intervals.lines(spark, str(tmp_path / "a.gtf")))
    r = g.first()
    assert (r.start, r.stop, r.strand, r.attributes) == (10, 20, "-", {"gene_id": "G 1", "exon_number": "2", "note": "x"})
    flipped = intervals.inverted(g, spark.createDataFrame([("c1", 100)], "name string, length long")).first()
    assert (flipped.start, flipped.stop) == (80, 90)
    (tmp_path / "a.gff3").write_text("c1\ts\tgene\t1\t9\t3\t+\t0\tID=g%20x;Parent=p;Empty=\n")
    assert intervals.gff3(intervals.lines(spark, str(tmp_path / "a.gff3"))).first().attributes == {"ID": "g x", "Parent": "p", "Empty": ""}


def test_fastx(spark, tmp_path):
    import gzip

    (tmp_path / "a.fa").write_text(">c1 first\nACGT\nAC\n>c2\n\n>c3\nTTTT\n")
    with gzip.open(tmp_path / "b.fq.gz", "wt") as f:
        f.write("@r1 x\nACGT\n+\n@@II\n@r2\nAC\nGT\n+r2\nII\nII\n")
    fa = fastx.read(spark, str(tmp_path / "a.fa"))
    assert [tuple(r) for r in fa.collect()] == [("c1", "first", "ACGTAC", None), ("c2", None, "", None), ("c3", None, "TTTT", None)]
    assert [tuple(r) for r in fastx.read(spark, str(tmp_path / "b.fq.gz")).collect()] == [("r1", "x", "ACGT", "@@II"), ("r2", None, "ACGT", "IIII")]
    chunks = fastx.chunked(fa, 4)
    wanted = spark.createDataFrame([("c1", 2, 6), ("c1", 3, 3), ("c1", 5, 99), ("c3", 10, 12), ("zz", 0, 1)], "contig string, start long, stop long")
    assert {(r.contig, r.start): r.seq for r in fastx.fetch(chunks, wanted, 4).collect()} == {("c1", 2): "GTAC", ("c1", 3): "", ("c1", 5): "C", ("c3", 10): ""}
    assert fastx.dictionary_text(fa).first().value.startswith("@SQ\tSN:c1\tLN:6\tM5:")


def test_blocks_and_sniffing(tmp_path):
    data = random.Random(1).randbytes(200_000)
    packed = bgzf.compress(data)
    (tmp_path / "x.gz").write_bytes(packed)
    with open(tmp_path / "x.gz", "rb") as f:
        assert b"".join(bgzf.blocks(f)) == data
    assert not bgzf.is_truncated(packed[-28:]) and bgzf.is_truncated(packed[:-5])
    assert bgzf.sniff(bgzf.compress(b"BAM\1"))["format"] == "bam" and bgzf.sniff(TEXT.encode())["format"] == "vcf" and bgzf.sniff(b"@r1\nAC\n")["format"] == "fastq" and bgzf.sniff(b"c\t1\t2\n")["format"] == "bed"


def test_bam_round_trip(spark, tmp_path):
    from loomseq.sources import bam, sam
    from tests.test_records import HEADER as READ_HEADER
    from tests.test_records import SAM

    df = sam.parse(spark.createDataFrame([(v, 0, i) for i, v in enumerate(SAM)], "value string, file_id int, rec_no long").coalesce(1), READ_HEADER)
    path = f"file://{tmp_path}/out"
    bam.write(df.coalesce(1), READ_HEADER, path)
    back = bam.read(spark, path)
    assert [r.value for r in sam.lines(back).collect()] == SAM
    assert back.where("tid = 1").count() == 1 and back.where("mapq >= 60 and pos < 50").count() == 1


def test_bam_in_pieces(spark, tmp_path):
    from loomseq.sources import bam
    from tests.test_records import HEADER as READ_HEADER

    rng = random.Random(5)
    names = dict(enumerate(READ_HEADER.references))
    rows = []
    for i in range(3000):
        n = rng.choice([0, 5, 30, 150, 150, 20_000 if i % 500 == 7 else 40])
        seq, qual = "".join(rng.choice("ACGTN") for _ in range(n)), "".join(chr(33 + rng.randrange(60)) for _ in range(n))
        tid, pos = rng.choice([(-1, -1), (0, rng.randrange(900)), (1, rng.randrange(400))])
        rows.append({"qname": f"r{i}", "flag": rng.randrange(4096), "tid": tid, "rname": names.get(tid), "pos": pos, "end_pos": pos + max(n, 1), "mapq": rng.randrange(60), "cigar": f"{n}M" if n else "*", "cigar_ops": [{"op": 0, "len": n}] if n else None, "mate_tid": -1, "mate_rname": None, "mate_pos": -1, "tlen": 0, "seq": seq or None, "qual": qual or None, "tags": [("NM", {"type": "i", "i": i, "d": None, "s": None, "a": None}), ("XS", {"type": "Z", "i": None, "d": None, "s": "x" * rng.randrange(9), "a": None})]})
    body = bam.top_bytes(READ_HEADER) + b"".join(map(bam.encode, rows))
    (tmp_path / "a.bam").write_bytes(bgzf.compress(body))
    reader = bam.BamReader([str(tmp_path / "a.bam")])
    expected = [(r["qname"], r["flag"], r["pos"], r["seq"]) for r in rows]
    for size in (1 << 40, 5_000, 20_011, 70_000, 200_000):
        reader.split_bytes = size
        parts = reader.partitions()
        got = [r for p in parts for b in reader.read(p) for r in b.to_pylist()]
        assert [(r["qname"], r["flag"], r["pos"], r["seq"]) for r in got] == expected
        assert [r["rec_no"] for r in got] == sorted({r["rec_no"] for r in got}) and (len(parts) > 1) == (size < 1 << 40)
    df = bam.read(spark, str(tmp_path / "a.bam"), split_bytes=50_000)
    assert df.rdd.getNumPartitions() > 3 and df.where("tid = 1").count() == sum(r["tid"] == 1 for r in rows)


def test_md_and_modifications():
    assert md.reference_of("ACGTACGT", "4M2D4M", "2T1^GG4") == "ACtTGGACGT"
    assert md.reference_of("ACGT", "4M", "9") is None
    assert md.mismatches_of("ACGTACGT", "4M2D2M1I1M", "ACTTGGACT") == {"nm": 4, "md": "2T1^GG3"}
    got = md.modifications_of("AGCTCTCCAGAGTCGNACGCC", "C+mh,1,0;N+n,2", [10, 20, 30, 40, 50], False)
    assert [(m["base"], m["code"], m["pos"], m["qual"]) for m in got] == [("C", "h", 4, 20), ("C", "h", 6, 40), ("C", "m", 4, 10), ("C", "m", 6, 30), ("N", "n", 2, 50)]
    back = md.modifications_of("GGCAT", "C+m,0;", [7], True)
    assert [(m["pos"], m["strand"]) for m in back] == [(1, 1)] or back[0]["pos"] in (0, 1)


def test_exact_tests():
    assert abs(numeric.fisher(3, 1, 1, 3) - 0.4857142857) < 1e-9 and numeric.fisher(0, 0, 0, 0) == 1
    assert abs(numeric.binomial_two_sided(10, 2) - 0.109375) < 1e-9 and numeric.binomial_two_sided(4, 2) == 1
    assert numeric.hardy_weinberg(50, 25, 25) > 0.9 and numeric.hardy_weinberg(0, 50, 50) < 1e-10


def test_viterbi_and_posteriors_against_all_paths():
    import itertools

    rng = np.random.default_rng(1)
    n, k = 6, 2
    start, step, emit = rng.dirichlet(np.ones(k)), rng.dirichlet(np.ones(k), (n, k)), rng.random((n, k))
    chance = {p: start[p[0]] * emit[0, p[0]] * np.prod([step[i, p[i - 1], p[i]] * emit[i, p[i]] for i in range(1, n)]) for p in itertools.product(range(k), repeat=n)}
    assert tuple(models.viterbi(np.log(start), np.log(step), np.log(emit))) == max(chance, key=chance.get)
    total = sum(chance.values())
    expected = [[sum(c for p, c in chance.items() if p[i] == s) / total for s in range(k)] for i in range(n)]
    assert np.allclose(models.posteriors(start, step, emit), expected)


def test_homozygous_runs(spark):
    rng = random.Random(4)
    rows = [("s", "c", 1000 * i, float(rng.choice([0, 2]) if 300 <= i < 700 else rng.choice([0, 1, 1, 2])), 0.5) for i in range(1000)]
    got = models.runs_of_homozygosity(spark.createDataFrame(rows, "sample string, chrom string, pos long, dosage double, af double"), to_roh=1e-6, to_normal=1e-6).toPandas()
    best = got.sort_values("sites").iloc[-1]
    assert abs(best.start - 300_000) < 8000 and abs(best.stop - 700_000) < 8000


def test_variants_applied_to_sequences(spark):
    fa = spark.createDataFrame([("20", "AAAACCCCGGGG")], "name string, seq string")
    df = table(spark, ["20\t2\t.\tA\tT\t1\t.\t.\tGT\t0/1\t0/0\t0/0", "20\t5\t.\tCC\tC\t1\t.\t.\tGT\t1/1\t0/0\t0/0", "20\t6\t.\tC\tG\t1\t.\t.\tGT\t1/1\t0/0\t0/0", "20\t12\t.\tG\tGTT\t1\t.\t.\tGT\t1|0\t0/0\t0/0"])
    put = lambda **kw: models.apply_variants(fa, df, **kw).first().seq
    assert put() == "ATAACCCGGGGTT" and put(haplotype="1") == "AAAACCCGGGGTT" and put(haplotype="2") == "ATAACCCGGGG" and put(haplotype="I")[1] == "W"
    mask = spark.createDataFrame([("20", 8, 10)], "contig string, start long, stop long")
    assert put(mask=mask) == "ATAACCCNNGGTT"


def test_streams_land(spark, tmp_path):
    from loomseq import streaming
    from tests.test_records import HEADER as READ_HEADER
    from tests.test_records import SAM

    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.sam").write_text("@CO\tx\n" + "\n".join(SAM) + "\n")
    stream = streaming.read_sam(spark, str(tmp_path / "in"), READ_HEADER)
    streaming.land(stream, str(tmp_path / "out"), str(tmp_path / "ck")).awaitTermination(60)
    assert spark.read.parquet(str(tmp_path / "out")).count() == len(SAM)


def test_target_regions(spark):
    runs = spark.createDataFrame([("c", i * 100, i * 100 + 100, 25 if 40 <= i < 60 else 1) for i in range(100)], "rname string, start long, stop long, depth long")
    assert [(r.start, r.stop) for r in models.target_regions(runs).collect()] == [(4000, 6000)]
