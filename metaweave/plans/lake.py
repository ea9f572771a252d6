"""Entry point A: landed lake-catalog rows -> metadata records.

One lazy plan: scope -> (DESCRIBE sections -> columns -> partition flags
| view properties | table detail) -> routing -> details -> rejects -> delta
filter -> records.  Nothing runs until the caller acts on an output.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame

from metaweave.operators import describe as D
from metaweave.operators import detail as X
from metaweave.operators import records as R
from metaweave.operators.scope import SchemaSet, prune_to_scope, scope_include
from metaweave.session import materialize as write_stage


@dataclass
class LakeCatalog:
    scoped: DataFrame
    annotated: DataFrame
    columns: DataFrame          # with is_partition
    properties: DataFrame
    view_detail: DataFrame
    scraped: DataFrame
    checked: DataFrame          # every scoped entry with its reason
    kept: DataFrame
    delta: DataFrame
    table_records: DataFrame
    column_records: DataFrame
    last_updated: DataFrame

    @property
    def rejects(self) -> DataFrame:
        return X.rejects(self.checked)

    @property
    def records(self) -> DataFrame:
        return R.emit_records(self.table_records)


def lake_catalog(
    raw: Mapping[str, DataFrame],
    cluster: str,
    database: str = "delta",
    include: SchemaSet = None,
    exclude: SchemaSet = None,
    delta_only: bool = True,
    match: str = D.MATCH_DATA_TYPE_FIRST,
    table_detail: DataFrame | None = None,
    materialize: bool = False,
) -> LakeCatalog:
    """Build the whole lake pipeline over landed tables.

    ``raw`` holds ``raw_schemas``, ``raw_tables``, ``raw_table_detail``,
    ``raw_describe`` and ``raw_describe_ext``.  ``table_detail`` overrides the
    landed detail (for example with one derived from a commit log).

    With ``materialize`` the two stage results every later output reads —
    the column table and the checked table list — are written once under
    the checkpoint root and read back, so the records, the rejects, the
    graph and the search documents do not each re-run the DESCRIBE work.
    """
    def scope(df: DataFrame) -> DataFrame:
        return prune_to_scope(df, include, exclude)

    scoped = scope_include(raw["raw_schemas"], raw["raw_tables"], include, exclude)
    annotated = D.annotate_describe(scope(raw["raw_describe"]))
    columns = D.partition_columns(annotated, match)
    if materialize:
        columns = write_stage(columns, "columns")
    ext = scope(raw["raw_describe_ext"])
    properties = D.describe_properties(ext)
    view_detail = D.view_details(ext)
    detail = scope(table_detail if table_detail is not None else raw["raw_table_detail"])
    scraped = X.attach_details(X.route_kind(scoped), detail, view_detail)
    checked = X.drop_unscrapable(scraped, columns)
    if materialize:
        checked = write_stage(checked, "checked")
    kept = X.kept(checked)
    delta = X.delta_filter(kept, delta_only)
    table_records, column_records = R.table_metadata(delta, columns, database, cluster)
    return LakeCatalog(
        scoped=scoped, annotated=annotated, columns=columns, properties=properties,
        view_detail=view_detail, scraped=scraped, checked=checked, kept=kept, delta=delta,
        table_records=table_records, column_records=column_records,
        last_updated=R.table_last_updated(table_records),
    )
