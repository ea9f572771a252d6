"""Random DESCRIBE outputs against a model of the rules, with tiny
row blocks so that tables span many blocks."""

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from metaweave.model import RAW_DESCRIBE
from metaweave.operators import describe as D

NAMES = ["a", "b", "c", "dt", "date", "x#1", "", "# Partition Information", "# col_name", "Part 0"]
TYPES = ["int", "string", "a", "dt", "date", "c", ""]

row = st.tuples(st.sampled_from(NAMES), st.sampled_from(TYPES), st.sampled_from([None, "", "note"]))
table = st.lists(row, min_size=0, max_size=12)


def expected(rows, name_first=False):
    """What the rules say, by slicing: the first marker cuts the output in two; of each name in the upper part
    the last row holds; a name is a partition if some row of the lower part picks it among the names."""
    marked = ["#" in name or not name for name, _, _ in rows]
    cut = marked.index(True) if any(marked) else len(rows)
    upper = {name: i for i, (name, _, _) in enumerate(rows[:cut])}
    lower = [r for r, m in zip(rows[cut:], marked[cut:], strict=True) if not m]
    picks = ([n, t] if name_first else [t, n] for n, t, _ in lower)
    parts = {next(iter([c for c in pick if c in upper]), None) for pick in picks}
    return {name: (rows[i][1], rows[i][2] or None, i, name in parts) for name, i in upper.items()}


@settings(max_examples=25, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(tables=st.lists(table, min_size=1, max_size=4), block=st.sampled_from([1, 2, 3, 1 << 14]),
       name_first=st.booleans())
def test_columns_match_the_rules(spark, tables, block, name_first):
    data = []
    for t, rows in enumerate(tables):
        # Line numbers with gaps and an offset: only their order matters.
        data += [("s", f"t{t}", 3 * i + 5, n, d, c) for i, (n, d, c) in enumerate(rows)]
    df = spark.createDataFrame(data, RAW_DESCRIBE)
    match = D.MATCH_NAME_FIRST if name_first else D.MATCH_DATA_TYPE_FIRST
    got = {}
    for r in D.partition_columns(D.annotate_describe(df, block_size=block), match=match).collect():
        got.setdefault(r.table_name, {})[r.col_name] = (r.data_type, r.description, r.sort_order, r.is_partition)
    want = {f"t{t}": expected(rows, name_first) for t, rows in enumerate(tables)}
    want = {k: v for k, v in want.items() if v}
    assert got == want
