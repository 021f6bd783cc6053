from sparkmart.operators.sizing import broadcast_if_small, is_small
from sparkmart.operators.range_join import range_left_join
from sparkmart.operators.group_extreme import rows_at_group_min
from sparkmart.operators.per_key import first_per_key, last_per_key
from sparkmart.operators.running import running_count
from sparkmart.operators.upsert import upsert
from sparkmart.operators.quality import (accepted_values, checks_from_spec, key_checks,
                                         load_spec, not_null, require_rows, run_checks,
                                         unique)

__all__ = ["broadcast_if_small", "is_small", "range_left_join", "rows_at_group_min",
           "first_per_key", "last_per_key", "running_count", "upsert",
           "accepted_values", "checks_from_spec", "key_checks", "load_spec", "not_null",
           "require_rows", "run_checks", "unique"]
