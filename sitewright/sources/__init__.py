from sitewright.sources.readers import (
    index_lines, parse_bed, parse_blast6, parse_custody, parse_fasta, parse_fastq, parse_gff3, parse_paf, parse_reports,
    parse_sam, parse_site_stats, parse_tsv, paf_primary, read_bed, read_blast6, read_custody, read_fasta, read_fastq, read_gff3,
    read_paf, read_reports, read_sam, read_site_stats, read_tsv, ref_blocks,
)
from sitewright.sources.sinks import fasta_lines, tier_rows, write_fasta, write_table, write_tsv
