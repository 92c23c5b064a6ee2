"""Schemas of the interchange tables. Coordinates are 0-based and half-open unless a name says otherwise."""

from __future__ import annotations

TAGINFO_RAW = "cluster bigint, pflags int, polya_len int, mods string, umi string"
TAGINFO = "tile string, cluster bigint, pflags int, polya_len int, mods string, clones int"
REFINED_TAGINFO = "tile string, cluster bigint, pflags int, clones int, polya_len int, unaligned_polya int, mods string, unaligned_mods string"
SEQQUAL = "cluster bigint, seq5 string, qual5 string, seq3 string, qual3 string"
ASSOCIATIONS = "tile string, cluster bigint, gene string, ambig int"
INTERVALS = "chrom string, start int, end int, name string, score string, strand string"
GTF = "seqname string, source string, feature string, start int, end int, score string, strand string, frame string, attribute string"
CUTOFFS = "tile string, cycle int, cutoff double"
PRINCIPAL_ISOFORMS = "gene_name string, gene_id string, transcript string, ccds string, label string"

#: Tables of an annotation database dump (only the columns that come first and are used).
DUMPS = {
    "gene": "gene_id bigint, biotype string, analysis_id int, seq_region_id bigint, seq_region_start int, seq_region_end int, seq_region_strand int, display_xref_id bigint, source string, description string, is_current int, canonical_transcript_id bigint, stable_id string, version int",
    "transcript": "transcript_id bigint, gene_id bigint, analysis_id int, seq_region_id bigint, seq_region_start int, seq_region_end int, seq_region_strand int, display_xref_id bigint, source string, biotype string, description string, is_current int, canonical_translation_id bigint, stable_id string, version int",
    "translation": "translation_id bigint, transcript_id bigint, seq_start int, start_exon_id bigint, seq_end int, end_exon_id bigint, stable_id string, version int",
    "xref": "xref_id bigint, external_db_id int, dbprimary_acc string, display_label string, version string, description string, info_type string, info_text string",
    "external_db": "external_db_id int, db_name string, db_release string, status string, priority int, db_display_name string, type string",
    "object_xref": "object_xref_id bigint, ensembl_id bigint, ensembl_object_type string, xref_id bigint, linkage_annotation string, analysis_id int",
    "identity_xref": "object_xref_id bigint, xref_identity int, ensembl_identity int, xref_start int, xref_end int, ensembl_start int, ensembl_end int, cigar_line string, score double, evalue double",
    "ontology_xref": "object_xref_id bigint, source_xref_id bigint, linkage_type string",
    "stable_id_event": "old_stable_id string, old_version int, new_stable_id string, new_version int, mapping_session_id int, type string, score double",
}
