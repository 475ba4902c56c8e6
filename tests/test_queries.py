"""Every registered query against its SQL, and the driver contract."""

import __spark_entry__ as entry_point
import compare
import pytest

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return compare.connect(SMALL)


@pytest.mark.parametrize("name", sorted(entry_point.QUERIES))
def test_query_equals_sql(spark, con, name):
    found = entry_point.queries()[name](spark, SMALL).toArrow()
    expected = con.sql(entry_point.oracle_sql()[name]).to_arrow_table()
    assert len(found) > 0
    assert compare.difference(compare.frame_of(found), compare.frame_of(expected)) == ""


def test_entry(spark):
    assert entry_point.entry(spark).count() == 5


def test_difference_is_noticed():
    a, b = (compare.pd.DataFrame({"x": [1, v]}) for v in (2, 3))
    assert compare.difference(a, a) == ""
    assert "x: '2' / '3'" in compare.difference(a, b)
    assert "rows" in compare.difference(a, b.head(1))
    assert "columns" in compare.difference(a, b.rename(columns={"x": "y"}))
