"""The queries of this subpackage, and SQL for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from .bpe_trie import op5_bpe_trie
from .collocations import OP11_SQL, op11_collocations
from .cotraining import op1_cotraining
from .licenses import OP10_SQL, op10_license_scan
from .neighbours import op9_neighbours
from .packing import op2_best_fit_packing
from .quality_rules import OP3_SQL, op3_quality_rules
from .resampling import op12_importance_resampling
from .secrets import op4_secret_scan
from .simhash import op7_simhash
from .token_counts import op8_token_counts
from .token_files import op6_token_files
from .url_rules import OP13_SQL, op13_url_filter

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_cotraining,
        op2_best_fit_packing,
        op3_quality_rules,
        op4_secret_scan,
        op5_bpe_trie,
        op6_token_files,
        op7_simhash,
        op8_token_counts,
        op9_neighbours,
        op10_license_scan,
        op11_collocations,
        op12_importance_resampling,
        op13_url_filter,
    )
}

ORACLES: dict[str, str] = {"op3_quality_rules": OP3_SQL, "op10_license_scan": OP10_SQL, "op11_collocations": OP11_SQL, "op13_url_filter": OP13_SQL}
