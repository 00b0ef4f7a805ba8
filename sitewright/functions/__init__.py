"""Pure Column functions (JVM side, no UDFs)."""
from sitewright.functions.calls import (
    copies_rounded, copy_class, flag_is, freq_gt, freq_zygosity, gt_zygosity, is_crispr_candidate,
    nhej, pam_and_type, pam_motif, zygosity_call,
)
from sitewright.functions.cigar import (
    cigar_blocks, cigar_ops, clip_left_len, clip_right_len, left_clip_seq, ref_end, ref_len, right_clip_seq,
)
from sitewright.functions.names import (
    classify_element, classify_element_summary, element_header, header_part, is_vector, parse_src_tag,
    safe_token, src_tag, src_tier, strip_src_tag, target_scope,
)
from sitewright.functions.sequence import (
    clean_seq, eff_len, gc, has_run, iupac_regex, n_gaps, norm_chrom, revcomp, tm_nn, translate_codon,
)
