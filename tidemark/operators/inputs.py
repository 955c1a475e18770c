"""Rules of the shared inputs table, and frames that own their limit."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..errors import TidemarkError

LABEL, UUID = "^[A-Za-z0-9_.:/+-]{1,128}$", "^[0-9a-f]{8}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{12}$"
CONNECTORS = ("mariadb", "mssql", "mysql", "oracle", "postgres", "spark")
MOST_ROWS, MOST_BYTES, MOST_SECONDS = 100_000, 1 << 30, 31_536_000
_RISING = ("input_id", "ts_field", "id_field", "overlap_secs")
_LIMITS = {"GlobalLimit", "LocalLimit", "Offset", "Tail"}


def input_issues(inputs: DataFrame) -> DataFrame:
    """(name, issue): one row per broken rule of inputs(name, connector, mode, input_id, ts_field, id_field,
    overlap_secs, max_rows, max_bytes)."""
    rising, batch = F.col("mode") == "rising", F.col("mode") == "batch"

    def field(c):
        return F.col(c).isNull() | (F.col(c) == "") | (F.octet_length(c) > 63) | F.col(c).rlike(r"[\x00-\x1f\x7f-\x9f]")

    nil = "00000000-0000-0000-0000-000000000000"
    keys = F.lit(False)
    for c in _RISING:
        keys |= F.col(c).isNotNull()
    rules = [
        (~F.coalesce(F.col("name").rlike(LABEL), F.lit(False)), "name"),
        (~F.coalesce(F.col("connector").isin(*CONNECTORS), F.lit(False)), "connector"),
        (~F.coalesce(rising | batch, F.lit(False)), "mode"),
        (rising & (F.col("connector") == "oracle"), "oracle_is_batch_only"),
        (~F.coalesce(F.col("max_rows").between(1, MOST_ROWS), F.lit(False)), "max_rows"),
        (~F.coalesce(F.col("max_bytes").between(1, MOST_BYTES), F.lit(False)), "max_bytes"),
        (batch & keys, "rising_keys_in_batch"),
        (rising & (~F.coalesce(F.col("input_id").rlike(UUID), F.lit(False)) | (F.col("input_id") == nil)), "input_id"),
        (rising & field("ts_field"), "ts_field"),
        (rising & (field("id_field") | (F.col("id_field") == F.col("ts_field"))), "id_field"),
        (rising & ~F.coalesce(F.col("overlap_secs"), F.lit(0)).between(0, MOST_SECONDS), "overlap"),
    ]
    issues = F.array_compact(F.array(*[F.when(bad, F.lit(what)) for bad, what in rules]))
    return inputs.select("name", F.explode(issues).alias("issue"))


def pagination_guard(base: DataFrame) -> DataFrame:
    """base, unless the top of its plan limits or offsets rows: pages belong to the scan."""
    plan = base._jdf.queryExecution().analyzed()
    while True:
        kind = plan.getClass().getSimpleName()
        if kind in _LIMITS:
            raise TidemarkError("base_has_limit", "the base query must not limit or offset its rows")
        if kind not in {"Project", "SubqueryAlias", "View", "Sort"} or plan.children().size() != 1:
            return base
        plan = plan.children().head()


def preview(base: DataFrame, max_rows: int = 100, max_bytes: int = 1_000_000) -> DataFrame:
    """At most max_rows rows of the base; fails if their lines exceed max_bytes. Limits can only be lowered."""
    from ..functions.encode import ndjson_line

    if not (1 <= max_rows <= 100 and 1 <= max_bytes <= 1_000_000):
        raise TidemarkError("preview_limit", "at most 100 rows and 1,000,000 bytes")
    some = base.limit(max_rows)
    used = some.select(F.sum(F.octet_length(ndjson_line(some)) + 1).alias("b")).first()["b"] or 0
    if used > max_bytes:
        raise TidemarkError("preview_bytes", f"{used} bytes exceed {max_bytes}")
    return some
