"""Schemas of the record types, as DDL."""

CIGAR = "array<struct<op:string,len:int>>"
ALIGNMENT = f"name string, flag int, chrom string, pos long, mapq int, cigar {CIGAR}, next_chrom string, next_pos long, tlen int, seq string, qual string, tags map<string,string>"
#: The call table on disk; `sample` is prepended to each row.
CALL = (
    "sample string, chr string, s long, e long, size long, tsd long, pbp long, nbp long, rep_repeat string, repeat_family string, repeat_class string, ram long, pram long, nram long, "
    "cr long, pcr long, ncr long, acr long, pacr long, nacr long, acrr double, pram_start long, pram_end long, nram_start long, nram_end long, pgene string, ngene string, score double, s2n double, oi int, desc string, conf int"
)
RMSK = "chrom string, start long, end long, is_rc boolean, sub_type string, divergence double, family string, cns_start int, cns_end int, ordinal long"
FASTA = "name string, seq string, len long"
FASTQ = "name string, seq string, qual string"
FAI = "name string, len long, offset long, line_blen int, line_len int"
REPEAT = "chrom string, start long, end long, name string, class string, family string"
GENE = "strand string, s long, e long, name string, type string"
RAM = "repeat_name string, repeat_class string, repeat_family string, read_name string, pos long, mate_seq string"
BLAST = "query string, subject string, identity double, length int, mismatches int, gaps int, q_start long, q_end long, s_start long, s_end long, e_value double, bit_score double"
DISC_POS = "chrom string, map_pos long, mate_chrom string, mate_pos long, read_name string, mate_is_first int, insertion_pos long"

#: Bits of alignment flags.
PAIRED, UNMAPPED, MATE_UNMAPPED, REVERSE, READ1, READ2, SECONDARY, DUPLICATE, SUPPLEMENTARY = 1, 4, 8, 16, 64, 128, 256, 1024, 2048
