"""Types of the data model, as DDL; names follow the unified dataset."""

EXAMPLE = ("input string, output string, explanation string")
RAW = (
    "title string, description string, difficulty string, tags array<string>, examples_raw array<map<string,string>>, "
    "constraints array<string>, solution_code string, solution_language string, is_premium boolean, extra string, "
    "source_name string, source_url string, license string, raw_file string, raw_offset bigint, parser string, commit_hash string"
)
CANONICAL = (
    "id string, title string, description string, difficulty string, tags array<string>, "
    "examples array<struct<input:string,output:string,explanation:string>>, constraints array<string>, "
    "input_schema string, output_schema string, schema_inference_confidence double, "
    "canonical_solution struct<languages:array<string>,code_hashes:array<string>,ast_signature:string,code:string>, "
    "has_solution boolean, is_premium boolean, data_unavailable boolean, "
    "fingerprints struct<nl_embedding_id:string,code_embedding_id:string,content_hash:string>, "
    "license_meta struct<license:string,requires_legal_review:boolean,public_allowed:boolean,internal_use_only:boolean>, "
    "ingest_trace struct<parser:string,raw_file:string,raw_offset:bigint,commit_hash:string>, "
    "source_name string, source_list array<string>, aliases array<string>, deduplicated_into string, version int, "
    "validation struct<needs_review:boolean,needs_schema_review:boolean,requires_legal_review:boolean,reasons:array<string>>, "
    "history array<struct<step:string,detail:string>>, ord struct<source_idx:int,raw_file:string,raw_offset:bigint>"
)
TEMPLATE_OUTPUT = (
    "title string, description string, input_format string, output_format string, input_schema map<string,string>, "
    "output_schema map<string,string>, constraints array<string>, tie_breaker string, "
    "notes_for_variant_generator struct<n_range:array<string>,value_range:array<string>,special_flags:array<string>>, "
    "sample_public_tests array<map<string,string>>, sample_hidden_tests_design string, transform_seed string, exemplar_core_logic string"
)
PATTERN = (
    "pattern_id string, label string, size bigint, representative string, top_tags array<string>, "
    "difficulty map<string,bigint>, centroid array<float>, created_at timestamp, template_id string"
)
ASSIGNMENT = ("problem_id string, pattern_id string, confidence double, assigned_at timestamp")
TEMPLATE = (
    "template_id string, canonical_problem_id string, pattern string, transform_seed string, template string, signature_hash string, "
    "needs_review boolean, reasons array<string>, attempts int"
)
VARIANT = "template_id string, variant_seed string, args string, canonical_output string, signature_hash string"
