"""DataFrame -> DataFrame operators."""

from martlet.operators.dedup import (  # noqa: F401
    keep_first, top_k_per_key, large_top_k_per_key, distinct_values, sort_spec,
)
from martlet.operators.kinds import split_by_kind, union_kinds  # noqa: F401
from martlet.operators.lookup import (  # noqa: F401
    normalise_title, first_match_lookup, unmatched_titles, enrich_children,
    deletion_variants,
)
from martlet.operators.signatures import end_candidates, gram_candidates, similar_titles  # noqa: F401
from martlet.operators.quality import (  # noqa: F401
    null_blank_share, duplicate_count, quality_report, not_null_violations,
    unique_violations, fk_violations, max_length_violations,
    constraint_summary,
)
from martlet.operators.mart import (  # noqa: F401
    popular_entities, entity_kpis, load_summary, log_kpis, duration_view,
    casted_view, count_per_category, mode_comparison, stat_leaders,
    value_distribution, usage_ranking, live_rows, longest,
)
from martlet.operators.audit import (  # noqa: F401
    with_audit_columns, with_duration_seconds, audit_frame, observe_count,
)
from martlet.operators.quantiles import exact_quantiles, with_exact_quantiles  # noqa: F401
