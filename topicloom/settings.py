"""Metrics, thresholds and table schemas.

Fixed values: weights, thresholds, time-to-live, prompt budget and top-k sizes below are the
ones the results must be computed with.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T


@dataclass(frozen=True)
class Metric:
    """A weighted distance: vector terms (Euclidean) plus one category term.

    ``missing`` is the distance of a category pair the table does not list, ``empty`` the whole
    term when one side has no category. With ``use_shares`` each pair counts by the product of
    both shares, otherwise by one. ``cap`` limits the total to 1.
    """

    vectors: tuple[tuple[str, float], ...]
    category: float
    missing: float
    empty: float
    use_shares: bool
    cap: bool

    @property
    def gate(self) -> tuple[str, float]:
        """The vector term with the largest weight. As no term is negative,
        ``distance <= eps`` implies ``|x - y| <= eps / weight`` on it."""
        return max(self.vectors, key=lambda v: v[1])

    @property
    def columns(self) -> list[str]:
        return [c for c, _ in self.vectors]


# -- fixed values ------------------------------------------------------------------------------
DOC_TITLE = Metric((("title_vec", 0.8), ("content_vec", 0.1)), 0.1, 1.0, 1.0, True, False)
DOC_CONTENT = Metric((("content_vec", 0.8),), 0.2, 1.0, 1.0, True, False)
CLUSTER_SHARED = Metric((("centroid_vec", 0.75),), 0.25, 0.0, 0.0, True, True)
CLUSTER_FLAT = Metric((("centroid_vec", 0.8),), 0.2, 0.0, 0.0, False, True)

EPS_DOC_TITLE = 0.53
EPS_DOC_CONTENT = 0.59
EPS_CLUSTER_SHARED = 0.216
EPS_CLUSTER_FLAT = 0.15

MIN_SAMPLES = 2
TTL_DAYS = 30
OUTLIER_ALPHA = 2.0
OUTLIER_MIN_DOCS = 10
TOP_CATEGORIES = 20
PROMPT_CHARS = 4097
PROMPT_LABELS = 30
PROMPT_TITLES = 30
UNKNOWN_CATEGORY = "unknown"
NOISE_SUFFIX = "-1"
# ----------------------------------------------------------------------------------------------

#: Distances are compared after rounding to this many digits, so that the order in which
#: floating point terms are added cannot move a pair across a threshold.
DIGITS = 9

_vec = T.ArrayType(T.DoubleType())
_strings = T.ArrayType(T.StringType())

DOC_SCHEMA = T.StructType([
    T.StructField("url", T.StringType()),
    T.StructField("title", T.StringType()),
    T.StructField("categories", _strings),
    T.StructField("date_created", T.TimestampType()),
    T.StructField("title_embedding", _vec),
    T.StructField("content_embedding", _vec),
    T.StructField("summary_embedding", _vec),
])

CATEGORY_COUNTS = T.ArrayType(T.StructType([
    T.StructField("category", T.StringType()),
    T.StructField("n", T.LongType()),
]))

CENTRAL_DOC = T.StructType([
    T.StructField("url", T.StringType()),
    T.StructField("title", T.StringType()),
    T.StructField("categories", _strings),
    T.StructField("title_embedding", _vec),
    T.StructField("content_embedding", _vec),
])

_edge = T.StructType([T.StructField("url", T.StringType()), T.StructField("distance", T.DoubleType())])
BORDERS = T.ArrayType(T.StructType([
    T.StructField("min", _edge),
    T.StructField("max", _edge),
    T.StructField("avg", T.DoubleType()),
]))

#: The persisted tables. ``categories`` of clusters and communities is the multiset of member
#: categories in counted form: the plain list of a topic that holds a third of all documents
#: would not fit one row.
TABLES: dict[str, T.StructType] = {
    "categories_distances": T.StructType([
        T.StructField("id", T.LongType()),
        T.StructField("first_category", T.StringType()),
        T.StructField("second_category", T.StringType()),
        T.StructField("distance", T.DoubleType()),
    ]),
    "clusterized_docs": T.StructType([
        T.StructField("url", T.StringType()),
        T.StructField("cluster_id", T.StringType()),
        T.StructField("timestamp", T.DateType()),
        T.StructField("unclusterized", T.BooleanType()),
    ]),
    "clusters": T.StructType([
        T.StructField("uuid", T.StringType()),
        T.StructField("cluster_id", T.StringType()),
        T.StructField("cluster_label", T.StringType()),
        T.StructField("timestamp", T.DateType()),
        T.StructField("centroid_embedding", _vec),
        T.StructField("central_doc", CENTRAL_DOC),
        T.StructField("cluster_borders", BORDERS),
        T.StructField("tags", _strings),
        T.StructField("categories", CATEGORY_COUNTS),
        T.StructField("most_common_categories", _strings),
    ]),
    "cluster_communities": T.StructType([
        T.StructField("cluster_id", T.StringType()),
        T.StructField("community_id", T.StringType()),
        T.StructField("timestamp", T.DateType()),
        T.StructField("unclusterized", T.BooleanType()),
    ]),
    "communities": T.StructType([
        T.StructField("uuid", T.StringType()),
        T.StructField("community_id", T.StringType()),
        T.StructField("community_label", T.StringType()),
        T.StructField("timestamp", T.DateType()),
        T.StructField("size", T.LongType()),
        T.StructField("tags", _strings),
        T.StructField("categories", CATEGORY_COUNTS),
        T.StructField("most_common_categories", _strings),
    ]),
}

#: Upsert key of each table.
KEYS = {
    "categories_distances": ["first_category", "second_category"],
    "clusterized_docs": ["url"],
    "clusters": ["cluster_id"],
    "cluster_communities": ["cluster_id"],
    "communities": ["community_id"],
}
