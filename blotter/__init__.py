"""blotter: Spark-native incident analytics.

Clean and integrate incident sources, place points in areas, enrich them
from lookups, and compute monthly trends, shares and before/after
comparisons.  Every operator takes and returns a DataFrame.
"""

from blotter.operators.compare import (  # noqa: F401
    before_after, before_after_by_month, change_matrix, unpivot_matrix)
from blotter.operators.enrich import enrich_area  # noqa: F401
from blotter.operators.integrate import (  # noqa: F401
    IncidentSource, IntegrateSpec, conform, dedup_first, integrate_incidents, union_sources)
from blotter.operators.profile import (  # noqa: F401
    date_range, distinct_values, duplicate_keys, null_code_pairs, null_counts, numeric_quartiles,
    numeric_range, profile)
from blotter.operators.spatial import AreaIndex, index_areas, locate  # noqa: F401
from blotter.operators.trend import (  # noqa: F401
    add_trend_metrics, band_trend, category_group_trend, group_share, level_endpoints,
    level_trend, level_wide, monthly_counts, monthly_trend)
from blotter.sources.files import read_csv_text, read_csv_typed, write_table  # noqa: F401
from blotter.sources.geojson import area_dimension, read_areas, read_features  # noqa: F401

__version__ = "0.1.0"
