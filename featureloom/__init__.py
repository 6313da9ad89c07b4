"""Feature matrices on Spark: messy tables, graphs and value lists to labelled vectors."""

from .functions.buckets import PRESETS, bucket_edges, bucket_index
from .functions.cells import (
    clean_key, fix_decimal_comma, format_shift, is_decimal_comma, null_token, strip_ansi,
    strip_stereo, to_double,
)
from .operators.assembly import (
    as_dataframe, attach_labels, expand_copies, fuse, label_column, name_features,
    order_like_files, pad_vectors, ragged_vectors, split_meta, stack_vectors,
)
from .operators.backoff import fit_backoff, merge_backoff, predict_backoff
from .operators.cleaning import (
    clean_keys, decimal_comma_report, drop_incomplete, drop_null_features, fix_decimal_commas,
    null_counts, null_tokens, require_columns, take_columns,
)
from .operators.fingerprints import (
    circular_fingerprint, fold_bits, ngram_fingerprint, path_fingerprint, path_keys,
)
from .operators.fragments import graph_fragments, node_fragments
from .operators.graph import (
    both_directions, circular_signatures, expand_implicit, label_signature, notation_to_graph,
    select_nodes,
)
from .operators.histogram import (
    bucket_rejects, bucket_summary, bucketize, chunk_values, chunks, long_positions, sparse_histogram,
    vector_long,
)
from .operators.quality import (
    dedup_keep_first, degenerate_keys, duplicate_report, failed_keys, flag_rules,
    graph_metrics, graph_rules, observed, observed_summary, reject_degenerate, route, run_summary,
    screen_notation, warnings,
)
from .operators.rowgraphs import notation_paths
from .operators.subgraphs import (
    branched_fingerprint, branched_keys, circular_environments, notation_branched_fingerprint, notation_branched_keys, notation_circular_environments, subgraph_code,
)
from .plans.matrices import (
    distinct_records, fingerprint_matrix, hybrid_matrix, predict_values, signature_levels,
    spectral_matrix, spectral_vectors, verify_table,
)
from .plans.modes import MODES, build_matrix, run_mode
from .session import build_session, drop_staged, spread, stage
from .sinks.bucketed import (
    attach_bucketed, drop_bucketed, fuse_bucketed, write_bucketed, write_bucketed_labels,
)
from .sinks.tables import append_log, write_chunks, write_matrix, write_vectors, write_verified
from .sources.delimited import (
    detect_delimiter, expected_columns, malformed_records, read_delimited, split_malformed,
)
from .sources.dialects import file_dialects, read_dialects
from .sources.records import logical_records
from .sources.vectors import read_vector_values, read_vectors
