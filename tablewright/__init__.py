"""Table query and write operators for PySpark: every function takes and returns DataFrames or Columns."""

from __future__ import annotations

from .functions.convert import conform, convert, fitting_decimal, parse_json_list
from .functions.predicates import (
    and_,
    and_not,
    condition,
    contains,
    ends_with,
    eq,
    exists,
    ge,
    group,
    gt,
    in_list,
    in_query,
    is_null,
    is_true,
    le,
    lt,
    or_,
    or_not,
    other,
    raw,
    starts_with,
    where,
)
from .operators.nested import nested_chunks, nested_list, to_json_list
from .operators.paging import (
    deep_page,
    fetch_page,
    page,
    page_with_total,
    single_row,
    single_row_frame,
    sort_rows,
    total_count,
)
from .operators.pairs import pair_join, semi_join
from .operators.relational import (
    aggregate,
    column,
    constant,
    expression,
    inequality_join,
    join_on,
    project,
    raw_query,
)
from .operators.setops import combine
from .operators.writes import (
    Delete,
    Insert,
    Update,
    affected,
    apply_batch,
    delete_where,
    insert_rows,
    insert_select,
    update_where,
)
from .sources.tables import StoredBatch, load, store_batch

__all__ = [name for name in dir() if not name.startswith("_") and name not in ("annotations", "functions", "operators", "sources")]
