"""All registered queries."""

from framelearn.plans import metric_queries, model_queries, tensor_queries, text_queries  # noqa: F401
from framelearn.plans.registry import QUERIES, SQL  # noqa: F401
