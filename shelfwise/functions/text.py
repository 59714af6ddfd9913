"""Text and collection helpers shared by the operators."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Patterns that must match the source system's ISBN fields and
# item messages.  The ISBN alternation is written longest alternative first:
# Java regex takes the first matching alternative where the source system's
# engine takes the longest one.
ISBN_PATTERN = r"(?i)([0-9]{12,13}x?|[0-9]{9,10}x?)"
IN_TRANSIT = r"(?i).*IN\sTRANSIT.*"
IN_TRANSIT_TOO_LONG = r"(?i).*IN\sTRANSIT\sTOO\sLONG.*"
# The last route of a message, which may run over several lines.
LAST_TRANSIT_ROUTE = r"(?is).*IN\sTRANSIT\sfrom\s([0-9a-z]+)\sto\s([0-9a-z]+)"
TRANSIT_TIME = r"(?i)^([a-z]{3}\s[a-z]{1,3}\s[0-9]{2}\s[0-9]{4}\s[0-9]{2}:[0-9]{2}[AP]M)"


def nullif_empty(c) -> Column:
    c = F.col(c) if isinstance(c, str) else c
    return F.when(c == "", F.lit(None)).otherwise(c)


def ordered_values(value: Column, *order: Column) -> Column:
    """Aggregate: values ordered by ``order`` keys (NULL values kept as NULL entries).

    ``collect_list`` drops NULL inputs, so the value rides inside a struct whose
    leading fields are the sort keys; ``array_sort`` orders the structs and
    ``transform`` unwraps the value.  The result is NULL for no input rows only
    when the caller wraps it with ``empty_to_null``.
    """
    fields = [o.alias(f"k{i}") for i, o in enumerate(order)] + [value.alias("v")]
    arr = F.array_sort(F.collect_list(F.struct(*fields)))
    return F.transform(arr, lambda s: s["v"])


def ordered_values_where(cond: Column, value: Column, *order: Column) -> Column:
    """Aggregate: like ``ordered_values`` over only the rows where ``cond`` holds.

    Rows failing the condition contribute a NULL struct, which ``collect_list``
    skips; a row that matches with a NULL value still contributes its entry.
    """
    fields = [o.alias(f"k{i}") for i, o in enumerate(order)] + [value.alias("v")]
    arr = F.array_sort(F.collect_list(F.when(cond, F.struct(*fields))))
    return F.transform(arr, lambda s: s["v"])


def empty_to_null(arr: Column) -> Column:
    return F.when(F.size(arr) > 0, arr)


def truncate_ellipsis(c, n: int) -> Column:
    c = F.col(c) if isinstance(c, str) else c
    return F.when(F.length(c) > n, F.concat(F.substring(c, 1, n), F.lit("..."))).otherwise(c)


def json_object(*pairs) -> Column:
    """JSON text of a struct keeping NULL fields, like a SQL json_object."""
    cols = [v.alias(k) for k, v in pairs]
    return F.to_json(F.struct(*cols), {"ignoreNullFields": "false"})
