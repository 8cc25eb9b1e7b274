"""The canonical tables that every reader lands and every operator takes, as DDL."""


#: One typed tag value: the letter it has in text, and the value under the type's own field.
TAG = "struct<type:string,i:bigint,d:double,s:string,a:array<double>>"

READS = (
    "qname string, flag int, tid int, rname string, pos bigint, end_pos bigint, mapq int, cigar string,"
    "cigar_ops array<struct<op:int,len:int>>, mate_tid int, mate_rname string, mate_pos bigint, tlen bigint,"
    f"seq string, qual string, tags map<string,{TAG}>, rg string, file_id int, rec_no bigint"
)
CONTIGS = ("tid int, name string, length bigint")
VARIANTS = (
    "rid int, chrom string, pos bigint, start bigint, stop bigint, id string, ref string, alts array<string>, qual double,"
    "filters array<string>, info map<string,string>, format array<string>,"
    "samples array<struct<name:string,gt:struct<alleles:array<int>,phased:boolean>,fields:map<string,string>>>, file_id int, rec_no bigint"
)
FASTX = ("name string, comment string, seq string, qual string")
REF_CHUNKS = ("contig string, chunk bigint, seq string")
BED = (
    "contig string, start bigint, stop bigint, name string, score double, strand string, thick_start bigint, thick_stop bigint,"
    "item_rgb string, block_count int, block_sizes string, block_starts string"
)
GTF = (
    "contig string, source string, feature string, start bigint, stop bigint, score double, strand string, frame string, attributes map<string,string>"
)
