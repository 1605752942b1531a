from cabline.plans.oracle import oracle_sql  # noqa: F401
from cabline.plans.queries import QUERIES, entry  # noqa: F401
