"""Table schemas. Identity is the natural key named with each table; surrogate ids are plain columns."""

from __future__ import annotations

_REAGENT = "struct<name:string,concentration:string,concentration_unit:string>"
_MARKER = "struct<marker_name:string,value:string>"
STAGES = ("array<struct<stage_name:string,duration_days:string,base_medium:string,"
          f"supplements:array<{_REAGENT}>,growth_factors:array<{_REAGENT}>,small_molecules:array<{_REAGENT}>,"
          f"seeding_density:string,medium_change_frequency:string,stage_markers:array<{_MARKER}>>>")
ENDPOINT = (f"struct<markers:array<{_MARKER}>,"
            "functional_assays:array<struct<assay_name:string,value:string,unit:string>>>")
FLAGS = "array<struct<field:string,reason:string,details:string>>"

TABLES: dict[str, str] = {
    # key: pmc_id
    "papers": (
        "id bigint, pmc_id string, doi string, pmid string, title string, abstract string, article_type string, "
        "triage_category string, xml_path string, parsed_text_path string, supplement_dir string, "
        "supplement_text_path string, extraction_status string, processing_priority int, created_at timestamp, "
        "geo_status string, rnaseq_status string"),
    # key: paper_id
    "triage_results": (
        "paper_id bigint, category string, confidence double, reasoning string, base_protocols array<string>, "
        "key_cell_types array<string>, disease_context string, supplement_signal boolean"),
    # key: the whole row
    "paper_references": (
        "paper_id bigint, referenced_doi string, referenced_pmc_id string, referenced_id bigint, in_corpus boolean, "
        "resolved boolean"),
    # key: id
    "protocols": (
        "id bigint, paper_id bigint, protocol_arm string, is_optimized boolean, "
        "cell_source struct<type:string,line_name:string,organism:string>, "
        f"culture_system struct<format:string,substrate:string,oxygen_condition:string>, stages {STAGES}, "
        f"endpoint_assessment {ENDPOINT}, modifications string, step_sources string, base_protocol_doi string, "
        f"extraction_confidence double, extraction_notes string, incomplete_flags {FLAGS}, pass_number int, "
        "needs_manual_fetch boolean, created_at timestamp"),
    # key: doi where there is one
    "corpus_cache": "doi string, pmc_id string, title string, full_text string, source string, cached_at timestamp",
    # append only
    "processing_log": (
        "paper_id bigint, stage string, status string, error_message string, tokens_used int, duration_secs double, "
        "created_at timestamp"),
    # key: paper_id, gse_id
    "geo_accessions": (
        "id bigint, paper_id bigint, gse_id string, context string, confidence double, "
        "discovery_strategies array<string>, data_type string, platform string, sample_count int, series_title string, "
        "series_summary string, linked_pmids array<string>, submission_date string, soft_fetched boolean, "
        "created_at timestamp, organism string, grounding_status string"),
    # key: geo_accession_id, gsm_id
    "geo_samples": (
        "id bigint, geo_accession_id bigint, gsm_id string, sample_title string, source_name string, description string, "
        "characteristics map<string,string>, sra_accession string"),
    # key: geo_sample_id, protocol_id
    "geo_sample_stage_mappings": (
        "geo_sample_id bigint, protocol_id bigint, stage_name string, stage_number int, time_point_day int, "
        "condition_label string, mapping_confidence double, mapping_method string"),
    # key: paper_id
    "rnaseq_metadata": (
        "paper_id bigint, has_rnaseq boolean, rnaseq_type string, technology string, library_prep string, read_type string, "
        "read_length_bp int, sequencing_depth string, genome_build string, annotation string, alignment_tool string, "
        "quantification_tool string, normalization string, de_method string, "
        "accessions array<struct<repository:string,accession:string,context:string>>, "
        "deg_summary struct<comparisons:array<struct<n_up:int,n_down:int>>>, pathway_analysis string, "
        "data_availability struct<repository:string,classification:string,n_accessions:bigint>, extraction_notes string, "
        "created_at timestamp"),
    # key: paper_id, accession
    "repository_metadata": (
        "paper_id bigint, accession string, repository string, project_title string, organism string, data_type string, "
        "platform string, sample_count int, has_processed_matrix boolean, "
        "supplementary_files array<struct<filename:string,url:string,file_type:string,has_count_matrix:boolean>>, "
        "fetch_status string, raw_response string, created_at timestamp"),
    # key: paper_id, accession, gsm_id; rows of their own, as one series may have most of all samples
    "repository_samples": "paper_id bigint, accession string, gsm_id string, title string, source string",
    # append only
    "expression_values": (
        "id bigint, paper_id bigint, protocol_id bigint, gene_symbol string, gene_alias string, value double, unit string, "
        "condition_label string, time_point_day int, comparison string, padj double, source_type string, "
        "source_detail string, confidence double, created_at timestamp"),
}
