"""The expected counts of FIXTURES.md section 3 at sf0.01."""

import os

import pytest

from metaweave.operators import describe as D
from metaweave.operators import records as R
from metaweave.operators.detail import commit_log_detail
from metaweave.plans.queries import stages

SF = "/root/testdata/sf0.01"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="test data not present")


def counts(df, *cols):
    return {tuple(r[c] for c in cols): r["count"] for r in df.groupBy(*cols).count().collect()}


def test_expected_counts(spark):
    st = stages(spark, SF)
    lake = st.lake
    assert counts(lake.checked, "is_view", "reason") == {
        (False, "kept"): 8174, (False, "no_columns"): 129, (False, "no_detail"): 681,
        (True, "kept"): 5548, (True, "no_columns"): 112, (True, "no_detail"): 356}
    assert counts(lake.delta, "is_view") == {(False,): 5392, (True,): 1370}
    tr = lake.table_records
    assert counts(tr.where("last_modified IS NOT NULL"), "is_view") == {(False,): 4893}
    assert counts(tr.where("description IS NOT NULL"), "is_view") == {(False,): 4648, (True,): 263}
    cols = lake.columns
    assert cols.count() == 45832
    assert cols.where("description IS NOT NULL").count() == 22791
    assert cols.where("is_partition").count() == 4446
    sections = counts(D.describe_sections(st.fx.raw_describe), "section")
    assert sections[("marker",)] == 20000
    assert D.describe_properties(st.fx.raw_describe_ext).count() == 13837
    diff = counts(R.column_diff(cols, st.fx.columns_b(cols), include_same=True), "change")
    assert diff == {("added",): 1500, ("removed",): 2500, ("changed",): 12138, ("same",): 31194}
    assert R.table_signature(cols).count() == 14743
    assert commit_log_detail(st.fx.raw_commits).count() == 150
