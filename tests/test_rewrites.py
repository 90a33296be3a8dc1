"""Each rewritten model against its plain shape on the derived data, rows compared both ways."""

import pytest

from harness.rewrites import REWRITES
from harness.testdata import warehouse


@pytest.mark.parametrize("name", REWRITES)
def test_same_rows(spark, name):
    plain, used = (build(warehouse(spark, "/root/testdata/sf0.001")) for build in REWRITES[name])
    plain = plain.select(*used.columns)
    assert plain.count() == used.count() > 0
    assert plain.exceptAll(used).count() == 0 and used.exceptAll(plain).count() == 0
