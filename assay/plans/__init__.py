"""Named queries over the driver tables; importing this package registers them all."""

from assay.plans import catalog
from assay.plans import profile_queries  # noqa: F401
from assay.plans import feature_queries  # noqa: F401
from assay.plans import scalar_queries  # noqa: F401
from assay.plans import order_queries  # noqa: F401
from assay.plans import eval_queries  # noqa: F401
from assay.plans import knn_queries  # noqa: F401
from assay.plans import model_queries  # noqa: F401
from assay.plans import curve_queries  # noqa: F401
from assay.plans import explain_queries  # noqa: F401

QUERIES = catalog.QUERIES
ORACLE = catalog.ORACLE
